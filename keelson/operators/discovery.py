"""Implicit foreign keys: containment of values, naming, abbreviations, chains; and how their evidence is combined.

Relations are rows (from_table, from_column, to_table, to_column, relation_type, confidence,
discovery_method, evidence).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.vocabulary import ABBREVIATIONS, GENERIC_NAMES, ID_WORDS, NOISE_WORDS, REFERENCE_ENDINGS, TARGET_NAMES
from ..plans.store import stored
from .bridge import bridged
from .settings import Settings

#: Thresholds where none are given.
USUAL = Settings()
HOT_COLUMNS = 200
#: Sets of hot values that one array of a column numbers.
HOT_PART = 1 << 16
RELATION = ("from_table", "from_column", "to_table", "to_column", "relation_type", "confidence", "discovery_method", "evidence")


# Containment


def normalised(values: DataFrame) -> DataFrame:
    """(table, column, value): distinct values in one form; columns named as compound ones are taken apart, whole, before anything else."""
    some = values.where("value is not null")
    lists = some.where(V.is_compound(F.col("column"))).select("table", "column", F.explode(V.parts(F.col("value"))).alias("raw"))
    rows = some.where(~V.is_compound(F.col("column"))).select("table", "column", F.col("value").alias("raw")).unionByName(lists)
    found = V.in_one_form(rows, F.col("raw")).groupBy("table", "column", "value").agg(F.count("*").alias("n"))
    # Bound to the count, the condition stays behind the aggregation: before it, it would hold the steps of the form once for each use of each.
    return found.where(F.when(F.col("value").isNotNull(), F.col("n")) > 0).select("table", "column", "value")


def candidates(columns: DataFrame, norm: DataFrame, by: Settings = USUAL) -> DataFrame:
    """Columns that may take part in a relation, those of the highest priority of each table (80 usually)."""
    low = F.lower("column")
    x = V.number(F.col("value"))
    sized = norm.groupBy("table", "column").agg(F.count("*").alias("unique_values"), F.min(x).alias("min_val"), F.max(x).alias("max_val"))
    ratio = F.col("unique_values") / F.col("unique_count")
    id_like = V.has_any(low, ID_WORDS)
    rows = (
        columns.where((F.col("unique_count") >= by.min_values) & ~(V.has_any(low, NOISE_WORDS) & ~id_like))
        .join(sized, ["table", "column"])
        .where(F.col("unique_values") >= by.min_values)
        .withColumn("is_id_like", id_like)
        .withColumn("unique_ratio", ratio)
        .where(F.col("is_id_like") | F.col("unique_ratio").between(0.3, 1.0))
        .withColumn("priority", F.when(F.col("is_id_like"), 3).otherwise(0) + F.when(ratio >= 0.95, 2).when(ratio >= 0.8, 1).otherwise(0))
    )
    w = Window.partitionBy("table").orderBy(F.desc("priority"), F.desc("unique_ratio"), "ordinal")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= by.per_table).select(
        "table", "column", "dtype", F.col("total_count").alias("row_count"), "unique_values", "unique_ratio", "is_id_like", "is_pk", "priority", "min_val", "max_val"
    )


def inverted_index(norm: DataFrame, columns: DataFrame) -> DataFrame:
    """(value, n_columns) of the candidate columns."""
    return norm.join(columns.select("table", "column"), ["table", "column"], "left_semi").groupBy("value").agg(F.count("*").alias("n_columns"))


PAIR = ("table_a", "column_a", "table_b", "column_b")


def overlaps(norm: DataFrame, columns: DataFrame, changed: tuple[str, ...] | None = None, known: DataFrame | None = None) -> DataFrame:
    """(table_a, column_a, table_b, column_b, shared, gated): values that two columns of different tables share.

    ``gated`` leaves out values of over 200 columns, and pairs that share no other value are left out with them.  The columns of
    a value stand in one array; equal arrays are counted once, and those of at most 200 columns give the pairs.  What
    the pairs share beyond that comes from the hot values of each column (see ``_hot``), so a value in very many columns never
    makes pairs.  ``changed`` keeps pairs with one of these tables at least; pairs of ``known`` (table_a, column_a,
    table_b, column_b) are not counted.
    """
    tagged = norm.join(columns.select("table", "column"), ["table", "column"], "left_semi").select("value", F.struct("table", "column").alias("c"))
    if changed is not None:  # only values of these tables can make such a pair
        tagged = tagged.join(tagged.where(F.col("c.table").isin(*changed)).select("value").distinct(), "value", "left_semi")
    sets = tagged.groupBy("value").agg(F.sort_array(F.collect_set("c")).alias("cs")).where("size(cs) > 1")
    sets = stored(sets.groupBy("cs").agg(F.count("*").alias("n")), "value-columns")
    a = sets.where(F.size("cs") <= HOT_COLUMNS).select("cs", "n", F.posexplode("cs").alias("i", "a"))
    pairs = a.select("n", "a", F.explode(F.slice("cs", F.col("i") + 2, F.size("cs"))).alias("b")).where("a.table <> b.table")
    if changed is not None:
        pairs = pairs.where(F.col("a.table").isin(*changed) | F.col("b.table").isin(*changed))
    pairs = pairs.select("n", F.col("a.table").alias("table_a"), F.col("a.column").alias("column_a"), F.col("b.table").alias("table_b"), F.col("b.column").alias("column_b"))
    if known is not None:
        pairs = pairs.join(known.select(*PAIR).distinct(), list(PAIR), "left_anti")
    gated = pairs.groupBy(*PAIR).agg(F.sum("n").alias("gated"))
    hot = sets.where(F.size("cs") > HOT_COLUMNS)
    if not hot.limit(1).count():
        return gated.select(*PAIR, F.col("gated").alias("shared"), "gated")
    gated = stored(gated, "gated")
    return gated.join(_hot(gated, hot), list(PAIR), "left").select(*PAIR, (F.col("gated") + F.coalesce("hot", F.lit(0))).alias("shared"), "gated")


def _hot(pairs: DataFrame, hot: DataFrame) -> DataFrame:
    """(table_a, column_a, table_b, column_b, hot): how many values of very many columns the given pairs share.

    hot: (cs, n), n values in the same columns.  Each column gets the numbers of its sets in arrays, HOT_PART of them at most, whose intersections are summed.
    """
    numbered = stored(hot.select(F.monotonically_increasing_id().alias("id"), "n", "cs"), "hot")
    parts = max(1, -(-numbered.count() // HOT_PART))
    each = numbered.select("id", "n", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"), F.explode("cs").alias("c"))
    of = stored(each.groupBy("c", "part").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("ids")), "hot-columns")
    side = lambda s: of.select(F.col("c.table").alias(f"table_{s}"), F.col("c.column").alias(f"column_{s}"), "part", F.col("ids").alias(f"ids_{s}"))
    met = pairs.select(*PAIR).join(side("a"), ["table_a", "column_a"]).join(side("b"), ["table_b", "column_b", "part"])
    common = F.aggregate(F.array_intersect("ids_a", "ids_b"), F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    return met.groupBy(*PAIR).agg(F.sum(common).alias("hot"))


def _sides(pairs: DataFrame, columns: DataFrame) -> DataFrame:
    keep = ("dtype", "row_count", "unique_values", "is_id_like", "is_pk", "min_val", "max_val")
    for side in ("a", "b"):
        named = columns.select(F.col("table").alias(f"table_{side}"), F.col("column").alias(f"column_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in keep))
        pairs = pairs.join(named, [f"table_{side}", f"column_{side}"])
    return pairs


def scores(pairs: DataFrame, columns: DataFrame, by: Settings = USUAL) -> DataFrame:
    """Pairs that match, with match_type, direction and base score."""
    rows = _sides(pairs, columns)
    least = F.when(F.col("is_id_like_a") | F.col("is_id_like_b"), by.min_shared_id).otherwise(by.min_shared)
    rows = rows.where((F.col("gated") >= least) & (F.col("shared") >= by.min_shared_id))
    n, a, b = F.col("shared"), F.col("unique_values_a"), F.col("unique_values_b")
    key = (F.col("is_id_like_a") & F.col("is_pk_b")) | (F.col("is_id_like_b") & F.col("is_pk_a"))
    limit = F.when(key, by.id_containment).otherwise(by.containment)
    j = n / (a + b - n)
    bonus = F.when(F.col("is_id_like_a") & F.col("is_id_like_b"), 0.05).otherwise(0.0)
    a_in_b = (n / a >= limit) & (a <= b * 0.95)
    b_in_a = (n / b >= limit) & (b <= a * 0.95)
    overlap = j >= by.overlap
    direction = F.when(a_in_b, "a_to_b").when(b_in_a, "b_to_a").when(overlap, "unknown")
    score = (
        F.when(a_in_b, n / a * 0.7 + j * 0.2 + a / b * 0.1 + bonus)
        .when(b_in_a, n / b * 0.7 + j * 0.2 + b / a * 0.1 + bonus)
        .when(overlap, j * 0.8 + bonus)
    )
    return rows.withColumn("direction", direction).withColumn("score", score).where("direction is not null").withColumn(
        "match_type", F.when(F.col("direction") == "unknown", "fk_content_overlap").otherwise("fk_content_subset")
    )


def _small_range(side: str) -> Column:
    low, high, n = F.col(f"min_val_{side}"), F.col(f"max_val_{side}"), F.col(f"unique_values_{side}")
    span = high - low
    return F.coalesce((span > 0) & (span < 300) & (n < 200) & (high < 1000) & (n / span > 0.3), F.lit(False))


def _consecutive(side: str) -> Column:
    low, high, n = F.col(f"min_val_{side}"), F.col(f"max_val_{side}"), F.col(f"unique_values_{side}")
    span = high - low
    return F.coalesce((span > 0) & (n >= 3) & (n / (span + 1) > 0.85) & (low >= 0) & (high < 200), F.lit(False))


def _named(a: str, b: str) -> Column:
    """Whether a segment of the table's name (three characters at least) stands in the other side's column."""
    segments = F.filter(F.split(F.lower(f"table_{b}"), "_"), lambda s: F.length(s) >= 3)
    return F.exists(segments, lambda s: F.contains(F.lower(f"column_{a}"), s))


def adjusted(scored: DataFrame, by: Settings = USUAL) -> DataFrame:
    """Scores with what speaks for or against chance (column confidence); weak ones are dropped."""
    naming = _named("a", "b") | _named("b", "a")
    numeric = F.col("dtype_a").isin("int", "float") & F.col("dtype_b").isin("int", "float")
    no_id = ~(F.col("is_id_like_a") | F.col("is_id_like_b"))
    span = {s: F.col(f"max_val_{s}") - F.col(f"min_val_{s}") for s in "ab"}
    small_key = {s: F.col(f"is_pk_{s}") & (F.col(f"unique_values_{s}") < by.small_key) for s in "ab"}
    key_size = F.when(small_key["a"], F.col("unique_values_a")).otherwise(F.col("unique_values_b"))
    generic = F.lower(F.trim(F.col("column_a"))).isin(*GENERIC_NAMES) & F.lower(F.trim(F.col("column_b"))).isin(*GENERIC_NAMES)
    # Each step adds to the confidence or scales it, so the steps do not nest in one another.
    small = _small_range("a") & _small_range("b")
    one, none = F.lit(1.0), F.lit(0.0)
    same_type = F.when(F.col("dtype_a") == F.col("dtype_b"), 0.05).when(~numeric & no_id, -0.15).otherwise(none)
    chance = F.when(~small | naming, one).when((span["a"] < 50) & (span["b"] < 50), 0.30).otherwise(0.50)
    counted = F.when((_consecutive("a") | _consecutive("b")) & ~naming, 0.60).otherwise(one)
    vague = F.when(generic, 0.80).otherwise(one)
    tiny = F.when(small_key["a"] & small_key["b"], 0.25).when((small_key["a"] | small_key["b"]) & ~naming, F.when(key_size < 30, 0.40).otherwise(0.60)).otherwise(one)
    c = ((F.col("score") + same_type) * chance + F.when(small & naming, -0.10).otherwise(none)) * counted * vague * tiny
    limit = F.when(naming, F.col("score") + 0.05).otherwise(F.lit(9.0))
    confidence = V.cents(F.greatest(F.lit(0.05), F.least(c + F.when(naming, 0.10).otherwise(none), limit)))
    return scored.withColumn("confidence", confidence).where(F.col("confidence") >= by.weak)


def containment(adjusted_: DataFrame) -> DataFrame:
    """Relations from containment: a subset refers to its superset; equals to the key or to the smaller table."""
    key = {s: F.col(f"unique_values_{s}") >= F.col(f"row_count_{s}") * 0.95 for s in "ab"}
    rows = {s: F.col(f"row_count_{s}") for s in "ab"}
    forward = (
        F.when(F.col("direction") == "a_to_b", True)
        .when(F.col("direction") == "b_to_a", False)
        .when(key["a"] & ~key["b"], False)
        .when(key["b"] & ~key["a"], True)
        .when(rows["a"] > rows["b"] * 1.2, False)
        .when(rows["b"] > rows["a"] * 1.2, True)
    )
    side = lambda what, start: F.when(F.col("forward"), F.col(f"{what}_{start}")).otherwise(F.col(f"{what}_{'b' if start == 'a' else 'a'}"))
    return adjusted_.withColumn("forward", forward).where("forward is not null").select(
        side("table", "a").alias("from_table"), side("column", "a").alias("from_column"), side("table", "b").alias("to_table"), side("column", "b").alias("to_column"),
        F.col("match_type").alias("relation_type"), "confidence", F.lit("containment").alias("discovery_method"), F.concat(F.lit("shared("), F.col("shared"), F.lit(")")).alias("evidence"),
    )


def shared_values(relations: DataFrame, norm: DataFrame, size: int = 5) -> DataFrame:
    """(from_table, from_column, to_table, to_column, shared, examples): how many values the two ends share, and the smallest of them.

    Values are counted in partial sums; a window that keeps ``size`` of them is cut before its shuffle.
    """
    ends = relations.select(*RELATION[:4]).distinct()
    side = lambda t, c: norm.select(F.col("table").alias(t), F.col("column").alias(c), "value")
    ends = stored(ends, "ends")
    target = side("to_table", "to_column").join(F.broadcast(ends.select("to_table", "to_column").distinct()), ["to_table", "to_column"], "left_semi")
    met = side("from_table", "from_column").join(F.broadcast(ends), ["from_table", "from_column"]).join(target, ["to_table", "to_column", "value"])
    met = stored(met.select(*RELATION[:4], "value"), "evidence")
    w = Window.partitionBy(*RELATION[:4]).orderBy("value")
    few = met.withColumn("r", F.row_number().over(w)).where(F.col("r") <= size)
    few = few.groupBy(*RELATION[:4]).agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("examples"))
    return met.groupBy(*RELATION[:4]).agg(F.count("*").alias("shared")).join(few, list(RELATION[:4]))


# Naming


def abbreviations(spark: SparkSession) -> DataFrame:
    """(abbreviation, place, full_name)."""
    rows = [(a, k, f) for a, full in ABBREVIATIONS.items() for k, f in enumerate(full)]
    return spark.createDataFrame(rows, "abbreviation string, place int, full_name string")


def full_names(spark: SparkSession) -> DataFrame:
    """(full_name, abbreviations): the abbreviations that stand for a name."""
    return abbreviations(spark).groupBy("full_name").agg(F.array_join(F.array_sort(F.collect_set("abbreviation")), ",").alias("abbreviations"))


def words(texts: DataFrame) -> DataFrame:
    """(source, word, n_texts): words of letters and underscores in (source, text), in lower case, and how many of a source's texts hold each."""
    found = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit("([A-Za-z_]+)"), 1), F.lower))
    return texts.select("source", F.explode(found).alias("word")).groupBy("source", "word").agg(F.count("*").alias("n_texts"))


def abbreviations_among(found: DataFrame) -> DataFrame:
    """(source, word, place, full_name, n_texts): what the words that are abbreviations stand for."""
    return found.join(abbreviations(found.sparkSession), F.col("word") == F.col("abbreviation")).select("source", "word", "place", "full_name", "n_texts")


def full_names_among(found: DataFrame) -> DataFrame:
    """(source, word, abbreviations, n_texts): how the words that have abbreviations are shortened."""
    return found.join(full_names(found.sparkSession), F.col("word") == F.col("full_name")).select("source", "word", "abbreviations", "n_texts")


def expanded_names(names: DataFrame) -> DataFrame:
    """(column, expansion): what a column name without its ending may stand for, itself included."""
    known = abbreviations(names.sparkSession)
    stems = names.select("column").distinct().withColumn("stem", V.lookup_stem(F.col("column")))
    full = stems.join(known, stems["stem"] == known["abbreviation"]).select("column", F.col("full_name").alias("expansion"))
    return full.unionByName(stems.select("column", F.col("stem").alias("expansion"))).distinct()


def references(columns: DataFrame, tables: DataFrame) -> DataFrame:
    """(table, column, to_table): the table that a column name refers to, by the first rule that finds one.

    For each ending in turn: the rest is a table; an expansion of the name is; a run of its last parts, or one
    part of three characters, is; its last part is the first segment of a table's name (the shortest such table); a Chinese
    name is that of a table's entity.
    """
    spark = columns.sparkSession
    endings = list(dict.fromkeys(e.lower() for e in REFERENCE_ENDINGS))
    ends = F.filter(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(e).alias("e")) for k, e in enumerate(endings))), lambda x: F.lower("column").endswith(x["e"]) & (F.length("column") > F.length(x["e"])))
    base = columns.select("table", "column", F.explode(ends).alias("end")).select(
        "table", "column", F.col("end.k").alias("ending"), F.substring(F.lower("column"), F.lit(1), F.length("column") - F.length("end.e")).alias("prefix")
    )
    split = F.split("prefix", "_")
    exact = base.select("table", "column", "ending", F.lit(1).alias("step"), F.lit(0).alias("place"), F.col("prefix").alias("name"), F.lit(1).alias("least"))
    known = abbreviations(spark)
    full = base.join(known, V.lookup_stem(F.col("column")) == known["abbreviation"]).select(
        "table", "column", "ending", F.lit(2).alias("step"), "place", F.col("full_name").alias("name"), F.lit(1).alias("least")
    )
    stem = base.select("table", "column", "ending", F.lit(2).alias("step"), F.lit(99).alias("place"), V.lookup_stem(F.col("column")).alias("name"), F.lit(1).alias("least"))
    each = base.select("table", "column", "ending", split.alias("p"), F.posexplode(split).alias("i", "part"))
    runs = each.select("table", "column", "ending", F.lit(3).alias("step"), (F.col("i") * 2).alias("place"), F.array_join(F.slice("p", F.col("i") + 1, F.size("p")), "_").alias("name"), F.lit(2).alias("least"))
    single = each.select("table", "column", "ending", F.lit(3).alias("step"), (F.col("i") * 2 + 1).alias("place"), F.col("part").alias("name"), F.lit(3).alias("least"))
    asked = reduce(DataFrame.unionByName, (exact, full, stem, runs, single)).where(F.length("name") >= F.col("least"))
    names = tables.select(F.col("table").alias("to_table"), F.lower("table").alias("name"))
    found = asked.join(names, "name").select("table", "column", "to_table", F.struct("ending", "step", "place").alias("rank"))
    first = F.split(names["name"], "_")[0]
    stems = names.where(F.length(first) >= 3).groupBy(first.alias("last")).agg(F.min(F.struct(F.length("to_table").alias("n"), F.col("to_table"))).alias("t"))
    near = base.where(~F.col("column").rlike("[\\u4e00-\\u9fff]")).withColumn("last", F.element_at(split, -1)).join(stems, "last").where(F.lower("t.to_table") != F.col("prefix"))
    near = near.select("table", "column", F.col("t.to_table").alias("to_table"), F.struct("ending", F.lit(4).alias("step"), F.lit(0).alias("place")).alias("rank"))
    # A column with a Chinese name, that no other rule takes, refers to the table of its last entity.
    chinese = columns.select("table", "column").join(bridged(columns, tables), "column").select(
        "table", "column", "to_table", F.struct(F.lit(len(endings)).alias("ending"), F.lit(5).alias("step"), F.lit(0).alias("place")).alias("rank")
    )
    return reduce(DataFrame.unionByName, (found, near, chinese)).groupBy("table", "column").agg(F.min_by("to_table", F.struct("rank", "to_table")).alias("to_table"))


def naming(columns: DataFrame, tables: DataFrame, norm: DataFrame, base: float = 0.70, changed: tuple[str, ...] | None = None, known: DataFrame | None = None) -> DataFrame:
    """Relations from column names; confidence from types and from how far the values are contained.

    ``known`` (table, column, to_table, to_column, containment) holds shares that need no comparison of values.
    """
    found = references(columns, tables).where("table <> to_table")
    if changed is not None:
        found = found.where(F.col("table").isin(*changed) | F.col("to_table").isin(*changed))
    named = columns.where(F.lower("column").isin(*{n.lower() for n in TARGET_NAMES}))
    order = F.array_position(F.lit(list(dict.fromkeys(n.lower() for n in TARGET_NAMES))), F.lower("column"))
    fallback = named.groupBy("table").agg(F.min_by("column", order).alias("named_key"))
    targets = tables.join(fallback, "table", "left").select(F.col("table").alias("to_table"), F.coalesce("primary_key", "named_key").alias("to_column")).where("to_column is not null")
    edges = stored(found.join(targets, "to_table"), "naming")
    dtype = lambda t, c, name: columns.select(F.col("table").alias(t), F.col("column").alias(c), F.col("dtype").alias(name))
    edges = edges.join(dtype("table", "column", "d1"), ["table", "column"]).join(dtype("to_table", "to_column", "d2"), ["to_table", "to_column"], "left")
    ends = ["table", "column", "to_table", "to_column"]
    held = containments(edges.select(*ends) if known is None else edges.select(*ends).join(known, ends, "left_anti"), norm)
    edges = edges.join(held if known is None else held.unionByName(known.select(*ends, "containment")), ends, "left")
    share = F.col("containment")
    confidence = F.lit(base) + F.when(F.col("d1") == F.col("d2"), 0.1).otherwise(0.0)
    confidence = confidence + F.when(share >= 0.5, 0.15).when(share >= 0.2, 0.05).when(share == 0, -0.2).otherwise(0.0)
    return edges.select(
        F.col("table").alias("from_table"), F.col("column").alias("from_column"), "to_table", "to_column", F.lit("fk_naming_convention").alias("relation_type"),
        V.cents(F.least(F.lit(0.95), F.greatest(F.lit(0.1), confidence))).alias("confidence"), F.lit("naming_convention").alias("discovery_method"),
        F.concat(F.lit("name "), F.col("column")).alias("evidence"),
    )


def containments(edges: DataFrame, norm: DataFrame) -> DataFrame:
    """(table, column, to_table, to_column, containment): the share of a column's values that the other has; null if either has none.

    The edges (a row for each name that refers to a table) go to the values: joined by column, all values of one would be one task's.
    """
    edges = stored(edges.distinct(), "edges")
    left = norm.join(F.broadcast(edges), ["table", "column"])
    ends = F.broadcast(edges.select("to_table", "to_column").distinct())
    target = norm.select(F.col("table").alias("to_table"), F.col("column").alias("to_column"), "value", F.lit(1).alias("hit")).join(ends, ["to_table", "to_column"], "left_semi")
    some = target.select("to_table", "to_column").distinct().withColumn("some", F.lit(True))
    counted = left.join(target, ["to_table", "to_column", "value"], "left").groupBy("table", "column", "to_table", "to_column").agg((F.count("hit") / F.count("*")).alias("containment"))
    return counted.join(some, ["to_table", "to_column"], "left_semi")


# Abbreviations


def mined_abbreviations(relations: DataFrame, tables: DataFrame, least: float = USUAL.mined_from) -> DataFrame:
    """(abbreviation, to_table, confidence): from the vocabulary, and from strong relations whose column abbreviates its table."""
    spark = relations.sparkSession
    known = abbreviations(spark).where(F.length("abbreviation").between(2, 5))
    names = tables.select(F.col("table").alias("to_table"), F.lower("table").alias("low"))
    exact = known.join(names, F.col("full_name") == F.col("low")).withColumn("r", F.struct("place", F.lit(0).alias("k"), F.length("to_table").alias("n"), "to_table"))
    begun = known.join(names, F.col("low").startswith(F.concat("full_name", F.lit("_")))).withColumn("r", F.struct("place", F.lit(1).alias("k"), F.length("to_table").alias("n"), "to_table"))
    seeds = exact.unionByName(begun).groupBy("abbreviation").agg(F.min_by("to_table", "r").alias("to_table"))
    clean = V.clean_name(F.col("from_column"))
    mined = relations.where(F.col("confidence") >= least).select(clean.alias("abbreviation"), "to_table").where(F.length("abbreviation").between(2, 4)).where(
        V.is_subsequence(F.col("abbreviation"), F.lower("to_table"))
    )
    mined = mined.groupBy("abbreviation", "to_table").agg(F.count("*").alias("n"))
    joined = mined.join(seeds.withColumn("seed", F.lit(True)), ["abbreviation", "to_table"], "full_outer")
    start = F.when(F.col("seed"), 0.65).otherwise(0.50)
    confidence = F.when(F.col("n").isNull(), start).otherwise(F.least(F.lit(0.95), start + 0.1 * F.col("n")))
    return joined.select("abbreviation", "to_table", V.cents(confidence).alias("confidence"))


def abbreviated(columns: DataFrame, tables: DataFrame, norm: DataFrame, relations: DataFrame, by: Settings = USUAL) -> DataFrame:
    """Relations of columns whose clean name is an abbreviation of a table, where three tenths of their values fit."""
    patterns = mined_abbreviations(relations, tables, by.mined_from).withColumnRenamed("confidence", "base")
    named = columns.select("table", "column", V.clean_name(F.col("column")).alias("abbreviation"))
    keys = tables.where("primary_key is not null").select(F.col("table").alias("to_table"), F.col("primary_key").alias("to_column"))
    edges = named.join(patterns, "abbreviation").join(keys, "to_table").where("table <> to_table")
    known = relations.select(*_pair(*RELATION[:4])).distinct()
    edges = edges.select("*", *_pair("table", "column", "to_table", "to_column")).join(known, ["k1", "k2"], "left_anti")
    held = containments(edges.select("table", "column", "to_table", "to_column"), norm).where("containment >= 0.3")
    return edges.join(held, ["table", "column", "to_table", "to_column"]).select(
        F.col("table").alias("from_table"), F.col("column").alias("from_column"), "to_table", "to_column", F.lit("fk_abbreviation").alias("relation_type"),
        V.cents(F.col("base") * 0.8).alias("confidence"), F.lit("abbreviation").alias("discovery_method"), F.concat(F.lit("abbreviation "), F.col("abbreviation")).alias("evidence"),
    )


# Chains and combination


def _pair(t1: str, c1: str, t2: str, c2: str) -> tuple[Column, Column]:
    """The two ends of a relation in one order, whichever refers to which."""
    a, b = F.concat_ws(".", t1, c1), F.concat_ws(".", t2, c2)
    return F.least(a, b).alias("k1"), F.greatest(a, b).alias("k2")


def transitive(relations: DataFrame, least: float = USUAL.chained, limit: int = 500) -> DataFrame:
    """Relations A to C from strong A to B and B to C, where A and C are not related; the best chain of each pair, 500 in all."""
    strong = relations.where(F.col("confidence") >= least).select(*RELATION[:4], "confidence")
    e1, e2 = strong.alias("e1"), strong.alias("e2")
    chains = e1.join(e2, F.col("e1.to_table") == F.col("e2.from_table")).where("e1.from_table <> e2.to_table").select(
        F.col("e1.from_table").alias("from_table"), F.col("e1.from_column").alias("from_column"), F.col("e2.to_table").alias("to_table"), F.col("e2.to_column").alias("to_column"),
        V.cents(F.col("e1.confidence") * F.col("e2.confidence") * 0.5).alias("confidence"),
        F.concat(F.concat_ws(".", "e1.from_table", "e1.from_column"), F.lit("->"), F.concat_ws(".", "e1.to_table", "e1.to_column"), F.lit("->"), F.concat_ws(".", "e2.to_table", "e2.to_column")).alias("evidence"),
    )
    direct = relations.select("from_table", "to_table").unionByName(relations.select(F.col("to_table").alias("from_table"), F.col("from_table").alias("to_table"))).distinct()
    w = Window.partitionBy("from_table", "to_table").orderBy(F.desc("confidence"), "evidence")
    best = chains.join(direct, ["from_table", "to_table"], "left_anti").withColumn("r", F.row_number().over(w)).where("r = 1")
    best = best.withColumn("relation_type", F.lit("inferred_transitive")).withColumn("discovery_method", F.lit("transitive"))
    return best.orderBy(F.desc("confidence"), "evidence").limit(limit).select(*RELATION)


def with_feedback(relations: DataFrame, feedback: DataFrame) -> DataFrame:
    """Rejected relations go, confirmed ones are certain, each in either direction.  feedback: (relation_key 'a.b->c.d', status)."""
    forward = F.concat(F.concat_ws(".", "from_table", "from_column"), F.lit("->"), F.concat_ws(".", "to_table", "to_column"))
    backward = F.concat(F.concat_ws(".", "to_table", "to_column"), F.lit("->"), F.concat_ws(".", "from_table", "from_column"))
    keyed = relations.withColumn("forward", forward).withColumn("backward", backward)
    rejected = feedback.where("status = 'rejected'").select("relation_key").distinct()
    confirmed = feedback.where("status = 'confirmed'").select("relation_key").distinct()
    for key in ("forward", "backward"):
        keyed = keyed.join(rejected.withColumnRenamed("relation_key", key), key, "left_anti")
        keyed = keyed.join(confirmed.select(F.col("relation_key").alias(key), F.lit(True).alias(f"{key}_sure")), key, "left")
    sure = F.coalesce("forward_sure", "backward_sure")
    return keyed.withColumn("confidence", F.when(sure, 1.0).otherwise(F.col("confidence"))).select(*RELATION)


def fused(relations: DataFrame) -> DataFrame:
    """One relation per column pair, the surest; found by several methods, the confidences reinforce each other up to 0.98."""
    rows = relations.select("*", *_pair(*RELATION[:4]))
    best = F.max_by(F.struct(*RELATION), F.struct("confidence", *(c for c in RELATION if c != "confidence"))).alias("best")
    doubt = F.aggregate(F.sort_array(F.collect_list("confidence")), F.lit(1.0), lambda p, c: p * (1 - c))
    grouped = rows.groupBy("k1", "k2").agg(best, doubt.alias("doubt"), F.array_sort(F.collect_set("discovery_method")).alias("methods"))
    several = F.size("methods") > 1
    confidence = F.when(several, V.cents(F.least(F.lit(0.98), 1 - F.col("doubt")))).otherwise(F.col("best.confidence"))
    evidence = F.when(several, F.concat("best.evidence", F.lit(" [fused: "), F.array_join("methods", ","), F.lit("]"))).otherwise(F.col("best.evidence"))
    return grouped.select(*(F.col(f"best.{c}").alias(c) if c not in ("confidence", "evidence") else {"confidence": confidence, "evidence": evidence}[c].alias(c) for c in RELATION))


def deduplicated(relations: DataFrame, per_pair: int = USUAL.per_pair) -> DataFrame:
    """The surest relation of each column pair; of each table pair two, by method first and confidence second."""
    rows = relations.select("*", *_pair(*RELATION[:4]), F.least("from_table", "to_table").alias("t1"), F.greatest("from_table", "to_table").alias("t2"))
    method = F.when(F.col("discovery_method") == "naming_convention", 3).when(F.col("discovery_method") == "abbreviation", 2).when(F.col("discovery_method") == "containment", 1).otherwise(0)
    columns = Window.partitionBy("k1", "k2").orderBy(F.desc("confidence"), *RELATION[:4])
    pair = Window.partitionBy("t1", "t2").orderBy(F.desc("m"), F.desc("confidence"), *RELATION[:4])
    once = rows.withColumn("r", F.row_number().over(columns)).where("r = 1").withColumn("m", method)
    return once.withColumn("r", F.row_number().over(pair)).where(F.col("r") <= per_pair).select(*RELATION)


def final(relations: DataFrame, feedback: DataFrame | None = None, by: Settings = USUAL) -> DataFrame:
    """Feedback, fusion, deduplication, and the least confidence, in this order."""
    rows = with_feedback(relations, feedback) if feedback is not None else relations
    return deduplicated(fused(rows), by.per_pair).where(F.col("confidence") >= by.final)


def enhanced(relations: DataFrame, found: DataFrame, feedback: DataFrame | None = None, by: Settings = USUAL) -> DataFrame:
    """Relations of a graph with those that the strategies find on it again: as ``final``, but methods do not reinforce each other."""
    rows = relations.unionByName(found)
    rows = with_feedback(rows, feedback) if feedback is not None else rows
    return deduplicated(rows, by.per_pair).where(F.col("confidence") >= by.final)
