"""Derived assets: indexes, maps, profiles and texts that consumers query."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import cents, excel_letter, without_ending
from ..functions.vocabulary import DOMAIN_NAMES, ENTITIES, INDEX_ENDINGS


def value_index(cells: DataFrame, columns: DataFrame, limit: int = 5000) -> DataFrame:
    """(value, n_tables, n_locations, locations): values of key candidates and enumerations found in several tables; the most frequent ones."""
    wanted = columns.where("is_fk_candidate or is_enum").select("table", "column")
    found = cells.where("value is not null").join(F.broadcast(wanted), ["table", "column"], "left_semi")
    grouped = found.groupBy("value").agg(
        F.count_distinct("table").alias("n_tables"), F.count("*").alias("n_locations"), F.array_join(F.sort_array(F.collect_set(F.concat_ws(".", "table", "column"))), ",").alias("locations")
    )
    return grouped.where("n_tables >= 2").orderBy(F.desc("n_locations"), "value").limit(limit)


def column_index(columns: DataFrame) -> DataFrame:
    """(kind, name, tables): tables by column name, and by the name without its ending."""
    exact = columns.select(F.lit("exact").alias("kind"), F.col("column").alias("name"), "table")
    stem = without_ending(F.col("column"), INDEX_ENDINGS)
    short = columns.withColumn("name", stem).where(F.col("name") != F.lower("column")).select(F.lit("normalized").alias("kind"), "name", "table")
    return exact.union(short).groupBy("kind", "name").agg(F.array_join(F.sort_array(F.collect_set("table")), ",").alias("tables"))


def cn_segments(columns: DataFrame) -> DataFrame:
    """(segment, tables): tables by the Chinese entity names in their column names."""
    runs = F.array_join(F.regexp_extract_all("column", F.lit("([\\u4e00-\\u9fff]+)"), 1), "")
    found = F.explode(F.filter(F.lit(list(ENTITIES)), lambda e: F.contains(runs, e)))
    return columns.select("table", found.alias("segment")).groupBy("segment").agg(F.array_join(F.sort_array(F.collect_set("table")), ",").alias("tables"))


def domain_graph(relations: DataFrame, tables: DataFrame, least: float = 0.5) -> DataFrame:
    """(domain_a, domain_b, n_relations, avg_confidence, max_confidence) of relations between domains."""
    d = tables.select("table", "domain")
    rows = relations.where(F.col("confidence") >= least)
    rows = rows.join(F.broadcast(d.withColumnsRenamed({"table": "from_table", "domain": "d1"})), "from_table").join(F.broadcast(d.withColumnsRenamed({"table": "to_table", "domain": "d2"})), "to_table")
    rows = rows.where("d1 <> d2").groupBy(F.least("d1", "d2").alias("domain_a"), F.greatest("d1", "d2").alias("domain_b"))
    return rows.agg(F.count("*").alias("n_relations"), (F.sum(F.floor(F.col("confidence") * 100 + 0.5)) / F.count("*") / 100).alias("a"), F.max("confidence").alias("max_confidence")).select(
        "domain_a", "domain_b", "n_relations", cents(F.col("a")).alias("avg_confidence"), "max_confidence"
    )


def enum_cross_ref(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """(column, tables, shared, total, shared_values): enumerations of one name in several tables that agree on half of their values, two at least."""
    enums = columns.where("is_enum").select("table", "column")
    group = enums.groupBy("column").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("table")), ",").alias("tables")).where("n >= 2")
    values = cells.where("value is not null").join(F.broadcast(enums), ["table", "column"], "left_semi").groupBy("column", "value").agg(F.count_distinct("table").alias("k"))
    joined = values.join(F.broadcast(group), "column").groupBy("column", "tables").agg(
        F.count(F.when(F.col("k") == F.col("n"), 1)).alias("shared"), F.count("*").alias("total"), F.sort_array(F.collect_list(F.when(F.col("k") == F.col("n"), F.col("value")))).alias("v")
    )
    return joined.where("shared >= 2 and shared * 2 >= total").select("column", "tables", "shared", "total", F.array_join(F.slice("v", 1, 20), ",").alias("shared_values"))


def relation_graph(relations: DataFrame, least: float = 0.5) -> DataFrame:
    """(table, direction, neighbour, join_text, confidence): relations seen from both ends."""
    text = F.concat(F.concat_ws(".", "from_table", "from_column"), F.lit(" = "), F.concat_ws(".", "to_table", "to_column")).alias("join_text")
    rows = relations.where(F.col("confidence") >= least)
    out = rows.select(F.col("from_table").alias("table"), F.lit("out").alias("direction"), F.col("to_table").alias("neighbour"), text, "confidence")
    return out.union(rows.select(F.col("to_table").alias("table"), F.lit("in").alias("direction"), F.col("from_table").alias("neighbour"), text, "confidence"))


def cell_locator(columns: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """(table, column, column_index, letter, data_start_row) of each column in its sheet.

    ``starts`` (table, data_start_row) says where the data of a sheet begins; other sheets have one row of headers.
    """
    first = F.lit(2).cast("bigint")
    if starts is not None:
        columns = columns.join(starts.select("table", F.col("data_start_row").alias("_start")), "table", "left")
        first = F.coalesce(F.col("_start").cast("bigint"), first)
    return columns.select("table", "column", F.col("ordinal").cast("bigint").alias("column_index"), excel_letter(F.col("ordinal")).alias("letter"), first.alias("data_start_row"))


def row_locator(df: DataFrame, table: str, key: str, limit: int = 200, row: str | None = None) -> DataFrame:
    """(table, key, row): sheet rows by key, for tables of at most ``limit`` rows with unique keys.

    ``row`` names the column with the place of each row in its sheet; a table that has no order of its own is taken in order of the key, from row 2 on.
    """
    sized = df.select(F.col(key).cast("string").alias("key"), F.col(key).alias("k"), *([F.col(row).cast("bigint").alias("row")] if row else [])).limit(limit + 1)
    n = sized.agg(F.count("*").alias("n"), F.count_distinct("key").alias("d")).where(f"n <= {limit} and n = d")
    w = Window.orderBy("k")
    place = F.col("row") if row else (F.row_number().over(w) + 1).cast("bigint").alias("row")
    return sized.crossJoin(F.broadcast(n)).select(F.lit(table).alias("table"), "key", place)


def schema_summary(tables: DataFrame) -> DataFrame:
    """(domain, n_tables, tables)."""
    return tables.groupBy("domain").agg(F.count("*").alias("n_tables"), F.array_join(F.sort_array(F.collect_list("table")), ",").alias("tables"))


def summary_text(tables: DataFrame, relations: DataFrame, found: DataFrame) -> DataFrame:
    """(section, place, text): the lines of the summary for readers: tables by domain, then what the analysis found."""
    line = lambda df, section, text, place=F.lit("").alias("place"): df.select(F.lit(section).alias("section"), place, text.alias("text"))
    n = tables.agg(F.count("*").alias("t")).crossJoin(relations.agg(F.count("*").alias("r")))
    parts = [line(n, 0, F.concat(F.lit("# Schema Summary — "), "t", F.lit(" tables, "), "r", F.lit(" relations")))]
    fixed = tables.sparkSession.createDataFrame([(1, ""), (2, "可用配置表（按业务域分组）："), (4, ""), (5, "## 分析洞察")], "section int, text string")
    parts.append(fixed.select("section", F.lit("").alias("place"), "text"))
    parts.append(line(schema_summary(tables), 3, F.concat(F.lit("["), "domain", F.lit("] "), F.replace("tables", F.lit(","), F.lit(", "))), F.col("domain").alias("place")))
    names = lambda kind, text, order, most: (
        found.where(F.col("kind") == kind).withColumn("r", F.row_number().over(Window.partitionBy("kind").orderBy(*order)))
        .groupBy("kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("r") <= most, F.struct("r", text.alias("x"))))), lambda s: s["x"]), ", ").alias("first"), F.count("*").alias("n"))
    )
    score = F.concat("item", F.lit("("), (F.floor(F.col("score") * 10 + 0.5) / 10).cast("decimal(10,1)").cast("string"), F.lit(")"))
    parts.append(line(names("centrality", score, [F.desc("score"), "item"], 5), 6, F.concat(F.lit("核心枢纽表 Top5: "), "first")))
    parts.append(line(names("orphan", F.col("item"), ["item"], 15), 7, F.concat(F.lit("孤立表("), "n", F.lit("): "), "first", F.when(F.col("n") > 15, "...").otherwise(""))))
    counts = found.agg(F.count(F.when(F.col("kind") == "cycle", 1)).alias("cycles"), F.count(F.when(F.col("kind") == "module", 1)).alias("modules"))
    parts.append(line(counts, 8, F.concat(F.lit("循环依赖: "), F.when(F.col("cycles") > 0, F.concat("cycles", F.lit(" 个"))).otherwise("无"))))
    parts.append(line(counts.where("modules > 0"), 9, F.concat(F.lit("业务模块数: "), "modules")))
    return reduce(DataFrame.unionByName, parts)


def chunks_text(tables: DataFrame, columns: DataFrame, relations: DataFrame) -> DataFrame:
    """(table, place, text): the chunks as lines of markdown, a heading first and a blank line before each table."""
    n = tables.agg(F.count("*").alias("t")).crossJoin(relations.agg(F.count("*").alias("r")))
    head = F.array(F.lit("# Schema Graph LLM Export"), F.concat(F.lit("# "), "t", F.lit(" tables, "), "r", F.lit(" relations")))
    first = n.select(F.lit("").alias("table"), F.posexplode(head).alias("place", "text"))
    lines = F.concat(F.array(F.lit("")), F.split(F.concat(F.lit("#"), "chunk"), "\n"))
    return first.unionByName(llm_chunks(tables, columns, relations).select("table", F.posexplode(lines).alias("place", "text")))


def table_description(tables: DataFrame) -> DataFrame:
    """(table, description): a sentence of name, domain, size and key."""
    names = F.create_map(*(F.lit(x) for d, n in DOMAIN_NAMES.items() for x in (d, n[0])))
    size = F.when(F.col("row_count") < 200, "小型").when(F.col("row_count") < 2000, "中型").otherwise("大型")
    text = F.concat("table", F.lit(": "), F.coalesce(names[F.col("domain")], F.lit("其他")), F.lit(", "), size, F.lit(", "), F.col("row_count"), F.lit(" 行, "), F.col("col_count"), F.lit(" 列"), F.coalesce(F.concat(F.lit(", 主键 "), "primary_key"), F.lit("")))
    return tables.select("table", text.alias("description"))


def table_profiles(tables: DataFrame, columns: DataFrame, relations: DataFrame) -> DataFrame:
    """(table, profile, searchable_text): a table's columns and relations as JSON, and the words to find it by."""
    cols = columns.groupBy("table").agg(F.sort_array(F.collect_list(F.struct("ordinal", "column", "dtype", "is_pk", "is_fk_candidate", "is_enum"))).alias("columns"))
    rel = relation_graph(relations).groupBy("table").agg(F.sort_array(F.collect_list(F.struct((-F.col("confidence")).alias("order"), "direction", "neighbour", "join_text"))).alias("relations"))
    size = F.when(F.col("row_count") < 500, "small").when(F.col("row_count") < 5000, "medium").otherwise("large")
    joined = tables.join(cols, "table").join(rel, "table", "left").withColumn("relations", F.coalesce("relations", F.array()))
    words = F.array_distinct(F.concat(F.array("table"), F.split("table", "_"), F.array("domain"), F.transform("columns", lambda c: c["column"]), F.transform("relations", lambda r: r["neighbour"]), F.array(size)))
    return joined.select("table", F.to_json(F.struct("domain", "row_count", "primary_key", "columns", "relations")).alias("profile"), F.array_join(words, " ").alias("searchable_text"))


def llm_chunks(tables: DataFrame, columns: DataFrame, relations: DataFrame, least: float = 0.65, each: int = 10) -> DataFrame:
    """(table, chunk): a short text per table: columns with hints, relations split into certain and likely."""
    hint = F.concat(F.when(F.col("is_pk"), " PK").otherwise(""), F.when(F.col("is_fk_candidate"), " FK?").otherwise(""), F.when(F.col("is_enum"), F.concat(F.lit(" enum("), F.col("unique_count"), F.lit(")"))).otherwise(""))
    line = F.concat("column", F.lit(":"), "dtype", hint)
    cols = columns.where("ordinal < 25").groupBy("table").agg(F.sort_array(F.collect_list(F.struct("ordinal", line.alias("line")))).alias("c"))
    w = Window.partitionBy("table", "direction").orderBy(F.desc("confidence"), "join_text")
    rel = relation_graph(relations, least).withColumn("r", F.row_number().over(w)).where(F.col("r") <= each)
    text = F.concat("direction", F.lit(" "), "join_text", F.when(F.col("confidence") >= 0.8, " [certain]").otherwise(" [likely]"))
    rels = rel.groupBy("table").agg(F.array_join(F.sort_array(F.collect_list(text)), "\n").alias("relations"))
    head = F.concat(F.lit("# "), "table", F.lit(" ("), "domain", F.lit(", "), F.col("row_count"), F.lit(" rows)\n"))
    joined = tables.join(cols, "table").join(rels, "table", "left")
    return joined.select("table", F.concat(head, F.array_join(F.transform("c", lambda x: x["line"]), ", "), F.coalesce(F.concat(F.lit("\n"), "relations"), F.lit(""))).alias("chunk"))


def report_nodes(tables: DataFrame, degrees: DataFrame) -> DataFrame:
    """(table, domain, degree, size) of the report's nodes."""
    return tables.join(degrees, "table").select("table", "domain", "degree", F.least(F.greatest(F.lit(2.0), 2 + F.col("degree") / 10), F.lit(8.0)).alias("size"))


def report_edges(relations: DataFrame) -> DataFrame:
    """(from_table, to_table, label, confidence) of the report's edges."""
    return relations.select("from_table", "to_table", F.concat("from_column", F.lit("->"), "to_column").alias("label"), "confidence")
