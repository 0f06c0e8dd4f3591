"""Column profiles of a set of tables: statistics, types, keys, enumerations, domains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import as_text, is_compound, number
from ..functions.vocabulary import DOMAIN_RULES, DOMAIN_WORDS, KEY_ENDINGS, KEY_NAMES

ENUM_VALUES, ENUM_SHARE = 50, 0.05
CELLS = "table string, ordinal int, column string, value string, n bigint"


def cells(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, ordinal, column, value, n): distinct values of every column that is not nested, null included.

    Each table is unpivoted and counted in one pass; counting before the shuffle leaves a row per value.  Meanwhile a number stands for
    table and column, so that a counted value takes little memory.  Long texts stand as digests, but for columns named as compound
    ones, which are taken apart later.
    """
    parts, names = [], []
    for name, df in sorted(tables.items()):
        fields = [(k, f) for k, f in enumerate(df.schema.fields) if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
        rows = F.array(*(F.struct(F.lit(len(names) + i).alias("at"), as_text(F.col(f"`{f.name}`"), f.dataType, is_compound(f.name)).alias("value")) for i, (_, f) in enumerate(fields)))
        names += [F.struct(F.lit(name).alias("table"), F.lit(k).alias("ordinal"), F.lit(f.name).alias("column")) for k, f in fields]
        parts.append(df.select(F.inline(rows)))
    counted = reduce(DataFrame.unionByName, parts).groupBy("at", "value").agg(F.count("*").alias("n"))
    return counted.select(F.get(F.array(*names), F.col("at")).alias("c"), "value", "n").select("c.table", "c.ordinal", "c.column", "value", "n")


def declared(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, kind): what the sources declare, as int, float, bool, datetime or str."""
    kinds = ((T.IntegralType, "int"), ((T.DoubleType, T.FloatType, T.DecimalType), "float"), (T.BooleanType, "bool"), ((T.TimestampType, T.TimestampNTZType, T.DateType), "datetime"))
    rows = [(t, f.name, next((k for c, k in kinds if isinstance(f.dataType, c)), "str")) for t, df in sorted(tables.items()) for f in df.schema.fields]
    return spark.createDataFrame(rows, "table string, column string, kind string")


def statistics(values: DataFrame) -> DataFrame:
    """(table, ordinal, column, unique_count, null_count, total_count); columns without a value are left out."""
    return (
        values.groupBy("table", "ordinal", "column")
        .agg(
            F.count("value").alias("unique_count"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.sum("n").alias("total_count"),
        )
        .where("unique_count > 0")
    )


def samples(values: DataFrame, size: int) -> DataFrame:
    """The smallest values of each column, at most ``size``."""
    w = Window.partitionBy("table", "column").orderBy("value")
    return values.where("value is not null").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= size).select("table", "column", "value", "rank")


def types(values: DataFrame, kinds: DataFrame) -> DataFrame:
    """(table, column, dtype).  Floats that are all whole are int; texts are judged by all distinct values: float if over
    four fifths of them are numbers, int if all of them are whole numbers, else str.

    Values are counted before they meet what is declared: joined by column, all values of one would be one task's.
    """
    x = number(F.col("value"))
    facts = values.where("value is not null").groupBy("table", "column").agg(
        F.count("*").alias("n"), F.count(x).alias("parsed"), F.count(F.when(x == F.floor(x), 1)).alias("integral")
    )
    dtype = (
        F.when(F.col("kind") == "float", F.when((F.col("parsed") > 0) & (F.col("integral") == F.col("parsed")), "int").otherwise("float"))
        .when(F.col("kind") != "str", F.col("kind"))
        .when(F.col("parsed") * 5 > F.col("n") * 4, F.when(F.col("integral") == F.col("n"), "int").otherwise("float"))
        .otherwise("str")
    )
    return kinds.join(facts, ["table", "column"], "left").select("table", "column", dtype.alias("dtype"))


def primary_keys(columns: DataFrame) -> DataFrame:
    """(table, primary_key): the column of the best score by name, uniqueness and type; the first one of equals."""
    low = F.lower("column")
    ratio = F.col("unique_count") / F.col("total_count")
    name = F.when(low.isin(*(k.lower() for k in KEY_NAMES)), 10).when(reduce(lambda a, b: a | b, (low.endswith(e) for e in KEY_ENDINGS)), 5).otherwise(0)
    unique = F.when(ratio >= 0.99, 10).when(ratio >= 0.95, 7).when(ratio >= 0.8, 3).otherwise(0)
    score = name + unique + F.when(F.col("dtype") == "int", 3).otherwise(1)
    candidate = (ratio >= 0.8) & ((name > 0) | (ratio >= 0.95))
    scored = columns.select("table", "column", "ordinal", ratio.alias("ratio"), F.when(candidate, score).alias("score"))
    best = F.max_by("column", F.when(F.col("score").isNotNull(), F.struct("score", -F.col("ordinal"))))
    first = F.min_by(F.struct("column", "ratio"), "ordinal")
    return scored.groupBy("table").agg(best.alias("best"), first.alias("first")).select(
        "table", F.coalesce("best", F.when(F.col("first.ratio") >= 0.8, F.col("first.column"))).alias("primary_key")
    )


def is_fk_candidate() -> Column:
    ratio = F.col("unique_count") / F.col("total_count")
    named = F.col("column").rlike(r"(?i)^(\w+?)(?:_id|_key|_no|_code|Id|Key|No|Code)$")
    return named | (F.lower("column").contains("_id") & F.col("dtype").isin("int", "float")) | ((F.col("dtype") == "int") & (ratio > 0.1) & (ratio < 0.95))


def is_enum() -> Column:
    return F.col("unique_count").between(2, ENUM_VALUES) & (F.col("unique_count") * 20 <= F.col("total_count"))


def columns(values: DataFrame, kinds: DataFrame) -> DataFrame:
    """One row per column: statistics, dtype, and whether it is the primary key, a foreign-key candidate, an enumeration, numeric."""
    known = statistics(values).join(types(values, kinds), ["table", "column"])
    return known.join(primary_keys(known), "table", "left").select(
        "table", "column", "ordinal", "dtype", "unique_count", "null_count", "total_count",
        F.coalesce(F.col("primary_key") == F.col("column"), F.lit(False)).alias("is_pk"),
        is_fk_candidate().alias("is_fk_candidate"), is_enum().alias("is_enum"), F.col("dtype").isin("int", "float").alias("is_numeric"),
    )


def domain(name: Column) -> Column:
    """The first domain of which a word occurs in the name, else other."""
    low = F.lower(name)
    chain = None
    for d, words in DOMAIN_RULES.items():
        hit = low.rlike("|".join(words))
        chain = F.when(hit, d) if chain is None else chain.when(hit, d)
    return chain.otherwise("other")


def best_domain(names: DataFrame, name: str) -> DataFrame:
    """Names with the domain of the longest word in them (of equals the first in the vocabulary), null if none."""
    words = [(d, w, len(w), k) for k, (d, ws) in enumerate(DOMAIN_WORDS.items()) for w in ws]
    found = F.array(*(F.struct(F.lit(n).alias("n"), F.lit(-k).alias("k"), F.lit(d).alias("d"), F.contains(F.lower(name), F.lit(w)).alias("hit")) for d, w, n, k in words))
    return names.withColumn("domain", F.array_max(F.filter(found, lambda x: x["hit"]))["d"])


def tables(columns_: DataFrame) -> DataFrame:
    """(table, row_count, col_count, primary_key, domain)."""
    return columns_.groupBy("table").agg(
        F.max("total_count").alias("row_count"), F.count("*").alias("col_count"), F.max(F.when(F.col("is_pk"), F.col("column"))).alias("primary_key")
    ).withColumn("domain", domain(F.col("table")))


def header_rows(rows: DataFrame, type_words: tuple[str, ...], limit: int = 5) -> DataFrame:
    """(source, header_rows) of untyped sources (source, row_index, cells): leading rows of types, names, descriptions or blanks.

    A row of types is over 7/10 type words, a row of names over 4/5 identifiers; after such a row, one
    with under a tenth of numbers is a description.  The first row of none of these ends the header.
    """
    cell = F.transform("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))))
    filled = F.filter(cell, lambda c: c != "")
    share = lambda test: F.size(F.filter(filled, test)) / F.size(filled)
    kind = (
        F.when(F.size(filled) == 0, "blank")
        .when(share(lambda c: F.lower(c).isin(*type_words)) > 0.7, "meta")
        .when(share(lambda c: c.rlike("^[A-Za-z_][A-Za-z0-9_]*$")) > 0.8, "meta")
        .when(share(lambda c: number(c).isNotNull()) < 0.1, "text")
        .otherwise("data")
    )
    first = rows.where(F.col("row_index") < limit).select("source", "row_index", kind.alias("kind"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("row_index", "kind"))), lambda x: x["kind"])
    start = F.struct(F.lit(0).alias("n"), F.lit(False).alias("meta"), F.lit(False).alias("done"))

    def fold(state: Column, k: Column) -> Column:
        header = ~state["done"] & ((k == "meta") | (k == "blank") | ((k == "text") & state["meta"]))
        return F.struct(F.when(header, state["n"] + 1).otherwise(state["n"]).alias("n"), (state["meta"] | (header & (k == "meta"))).alias("meta"), (~header).alias("done"))

    return first.groupBy("source").agg(ordered.alias("kinds")).select("source", F.aggregate("kinds", start, fold)["n"].alias("header_rows"))


def content_hash(df: DataFrame) -> DataFrame:
    """A digest of a whole table that does not depend on the order of its rows."""
    mixed = F.xxhash64(*(F.col(f"`{c}`").cast("string") if not isinstance(df.schema[c].dataType, T.StringType) else F.col(f"`{c}`") for c in df.columns))
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(mixed.cast("decimal(38,0)")), F.lit(0)).alias("s")).select(
        F.md5(F.concat_ws("|", F.lit(",".join(df.columns)), F.col("n"), F.col("s"))).alias("content_hash")
    )


def schema_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(table, column, change): columns added, removed, or of another type, in tables that both have."""
    both = before.select("table").distinct().join(after.select("table").distinct(), "table")
    joined = before.join(both, "table", "left_semi").alias("b").join(after.join(both, "table", "left_semi").alias("a"), ["table", "column"], "full_outer")
    change = F.when(F.col("b.dtype").isNull(), "added").when(F.col("a.dtype").isNull(), "removed").when(F.col("a.dtype") != F.col("b.dtype"), "type_changed")
    return joined.select("table", "column", change.alias("change")).where("change is not null")
