"""Questions asked of the metadata: which tables, which columns, how to join, where a cell is."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vocabulary import DOMAIN_RULES
from ..plans.store import stored
from .assets import relation_graph

#: Vectors, and queries, that are compared in one group.
VECTOR_ROWS, VECTOR_QUERIES = 20_000, 1000
#: Queries of a group that are scored at a time.
SCORED = 50
#: Vectors that an inverted file is fitted on.
SAMPLED = 16_384
STOP = " ,.?!的了是和与在"


def query_table(tables: DataFrame, relations: DataFrame, keyword: str) -> DataFrame:
    """(table, direction, neighbour, join_text, confidence): relations of the tables whose name has the keyword."""
    return relation_graph(relations, 0.0).where(F.contains(F.lower("table"), F.lit(keyword.lower())))


def query_columns(tables: DataFrame, columns: DataFrame, keyword: str, limit: int = 20) -> DataFrame:
    """(table, domain, row_count, col_count, primary_key, columns): the tables whose name has the keyword, with their first columns."""
    asked = tables.where(F.contains(F.lower("table"), F.lit(keyword.lower())))
    first = columns.groupBy("table").agg(F.array_sort(F.collect_list(F.struct("ordinal", "column"))).alias("c"))
    names = F.array_join(F.transform(F.slice("c", 1, limit), lambda x: x["column"]), ", ").alias("columns")
    return asked.join(first, "table").select("table", "domain", "row_count", "col_count", "primary_key", names)


def table_relations(relations: DataFrame, table: str) -> DataFrame:
    return relations.where((F.col("from_table") == table) | (F.col("to_table") == table)).select("from_table", "from_column", "to_table", "to_column", "confidence")


def grams(question: str, sizes: tuple[int, ...] = (4, 3, 2)) -> list[str]:
    """Character runs of a question without stop characters, the longest first."""
    text = "".join(c for c in question.lower() if c not in STOP)
    return list(dict.fromkeys(text[i : i + n] for n in sizes for i in range(len(text) - n + 1)))


def find_by_column(columns: DataFrame, question: str) -> DataFrame:
    """(table, column, n_grams): columns whose name has a run of the question, and how many runs."""
    hit = F.filter(F.lit(grams(question)), lambda g: F.contains(F.lower("column"), g))
    return columns.select("table", "column", F.size(hit).cast("bigint").alias("n_grams")).where("n_grams > 0")


def vector_topk(vectors: DataFrame, key: str, vector: str, probe: list[float] | Column, k: int) -> DataFrame:
    """(key, similarity): the k vectors nearest to a probe by cosine, in six decimals."""
    probe = probe if isinstance(probe, Column) else F.lit([float(x) for x in probe])
    v = F.transform(vector, lambda x: x.cast("double"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    dot = total(F.zip_with(v, probe, lambda a, b: a * b))
    norm = F.sqrt(total(F.transform(v, lambda a: a * a))) * F.sqrt(total(F.transform(probe, lambda a: a * a)))
    scored = vectors.select(key, (F.floor(dot / norm * 1000000 + 0.5) / 1000000).alias("similarity"))
    return scored.orderBy(F.desc("similarity"), key).limit(k)


def vector_neighbours(vectors: DataFrame, key: str, vector: str, k: int, every: int = 100) -> DataFrame:
    """(query, key, similarity): for each vector whose key ``every`` divides, the k nearest of all by cosine, in six decimals; ties by key.

    Blocks of queries meet blocks of vectors in groups of bounded size, which return k rows a query; itself is one of them.
    Null vectors, vectors of length zero, and vectors of another dimension than the query's are not compared.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v")).where("id is not null and v is not null")
    n = rows.count()
    sizes = {"rb": max(1, -(-n // VECTOR_ROWS)), "qb": max(1, -(-n // (VECTOR_QUERIES * every)))}

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(sizes[own])).cast("int").alias(own)
        return df.select("id", "v", block, F.explode(F.sequence(F.lit(0), F.lit(sizes[other] - 1))).alias(other)).groupBy("qb", "rb")

    met = dealt(rows, "rb", "qb").cogroup(dealt(rows.where(F.col("id") % every == 0), "qb", "rb")).applyInArrow(_nearest(k), "query bigint, id bigint, similarity double")
    w = Window.partitionBy("query").orderBy(F.desc("similarity"), "id")
    return met.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("query", F.col("id").alias(key), "similarity")


def _nearest(k: int):
    def matrices(block: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """(ids, unit vectors) by dimension."""
        ids, vectors = block.column("id").to_numpy(), block.column("v").combine_chunks()
        size = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, int)
        out = {}
        for d in np.unique(size[size > 0]).tolist():
            at = np.flatnonzero(size == d)
            m = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            norm = np.sqrt((m * m).sum(axis=1))
            out[d] = ids[at][norm > 0], m[norm > 0], norm[norm > 0]
        return out

    def run(_, rows: pa.Table, queries: pa.Table) -> pa.Table:
        found, base = [], matrices(rows)
        for d, (asked, q, q_norm) in matrices(queries).items():
            ids, m, norm = base.get(d, (np.zeros(0, np.int64), np.zeros((0, d)), np.zeros(0)))
            for start in range(0, len(asked), SCORED):  # so that few similarities are held at a time
                some = slice(start, start + SCORED)
                near = np.floor(q[some] @ m.T / (q_norm[some, None] * norm) * 1000000 + 0.5) / 1000000
                for one, line in zip(asked[some].tolist(), near):
                    at = np.flatnonzero(line >= np.partition(line, -k)[-k]) if len(line) > k else np.arange(len(line))
                    at = at[np.lexsort((ids[at], -line[at]))][:k]
                    found.append((np.full(len(at), one), ids[at], line[at]))
        parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query", "id", "similarity"), parts)))

    return run


class VectorIndex:
    """An inverted file: vectors in lists by the nearest of some centroids, searched list by list with exact similarities.

    Centroids, and the number of lists to look into, are fitted on a sample (SAMPLED rows by a hash of their key, at most): as many lists as
    hold ``target`` of the k nearest of the sample's own vectors, which lie farther apart than all vectors do.  Every vector is in a list.
    """

    def __init__(self, vectors: DataFrame, key: str, vector: str, k: int = 10, target: float = 0.97):
        rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v")).where("id is not null and v is not null")
        rows = rows.where(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) > 0)
        self.key, self.k = key, k
        some = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLED).toArrow()
        lists = [np.array(x.as_py()) for x in some.column("v")]
        sizes = np.array([len(x) for x in lists], int)
        self.dims = int(np.bincount(sizes).argmax()) if len(sizes) else 0
        unit = np.stack([x / np.sqrt(x @ x) for x in lists if len(x) == self.dims]) if len(sizes) else np.zeros((0, 0))
        self.centroids = _centroids(unit, max(1, int(len(unit) ** 0.5) // 2))
        self.probes = _probes(unit, self.centroids, k, target)
        self.rows = stored(rows.mapInArrow(_listed(self.dims, self.centroids, 1), "id bigint, v array<double>, list int"), "vector-lists")

    def nearest(self, every: int = 100) -> DataFrame:
        """(query, key, similarity): for each vector whose key ``every`` divides, the k nearest that its lists hold, by cosine, in six decimals; ties by key."""
        asked = self.rows.where(F.col("id") % every == 0).select("id", "v").mapInArrow(_listed(self.dims, self.centroids, self.probes), "id bigint, v array<double>, list int")
        sizes = self.rows.groupBy("list").agg(F.count("*").alias("n")).select("list", F.greatest(F.lit(1), F.ceil(F.col("n") / VECTOR_ROWS)).cast("int").alias("parts"))
        rows = self.rows.join(sizes, "list").select("id", "v", "list", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
        asked = asked.join(sizes, "list").select("id", "v", "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        blocks = max(1, -(-asked.count() // VECTOR_QUERIES // max(1, len(self.centroids))))
        block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
        rows = rows.select("id", "v", "list", "part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        met = rows.groupBy("list", "part", "block").cogroup(asked.select("id", "v", "list", "part", block).groupBy("list", "part", "block"))
        w = Window.partitionBy("query").orderBy(F.desc("similarity"), "id")
        found = met.applyInArrow(_nearest(self.k), "query bigint, id bigint, similarity double").withColumn("r", F.row_number().over(w))
        return found.where(F.col("r") <= self.k).select("query", F.col("id").alias(self.key), "similarity")


def _centroids(unit: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Directions that vectors gather around."""
    if not len(unit):
        return np.zeros((1, 0))
    out = unit[np.random.default_rng(1).choice(len(unit), n, replace=False)]
    for _ in range(rounds):
        near = (unit @ out.T).argmax(1)
        sums = np.zeros_like(out)
        np.add.at(sums, near, unit)
        size = np.sqrt((sums * sums).sum(1))[:, None]
        out = np.where(size > 0, sums / np.maximum(size, 1e-300), out)
    return out


def _probes(unit: np.ndarray, centroids: np.ndarray, k: int, target: float) -> int:
    """Lists, nearest first, that hold ``target`` of the k nearest of some vectors of a sample."""
    if len(unit) < 2:
        return 1
    asked = unit[:: max(1, len(unit) // 500)]
    near = np.argsort(-(asked @ unit.T), axis=1, kind="stable")[:, 1 : k + 1]
    of, order = (unit @ centroids.T).argmax(1), np.argsort(-(asked @ centroids.T), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None], axis=1)
    needed = np.sort(np.take_along_axis(place, of[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]) + 1


def _listed(dims: int, centroids: np.ndarray, n: int):
    """Each vector with each of the n lists nearest to it; those of another dimension with list -1."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("v")
            size = np.diff(vectors.offsets.to_numpy())
            own = np.flatnonzero(size == dims)
            m = vectors.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) if dims else np.zeros((len(own), 0))
            closest = np.argsort(-(m @ centroids.T), axis=1, kind="stable")[:, :n]
            other = np.flatnonzero(size != dims)
            at = np.concatenate((np.repeat(own, closest.shape[1]), other))
            lists = np.concatenate((closest.ravel(), np.full(len(other), -1))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), vectors.take(pa.array(at)), pa.array(lists)], names=["id", "v", "list"])

    return run


def recall_tables(tables: DataFrame, columns: DataFrame, question: str, near: DataFrame | None = None) -> DataFrame:
    """(table, route): tables by vector (1, if given), by column names (2), by words of their domain (3); the first route of each."""
    by_column = find_by_column(columns, question).select("table", F.lit(2).alias("route"))
    low = question.lower()
    domains = [d for d, words in DOMAIN_RULES.items() if any(w in low for w in words)]
    by_domain = tables.where(F.col("domain").isin(*domains) if domains else F.lit(False)).select("table", F.lit(3).alias("route"))
    routes = [by_column, by_domain] + ([near.select("table", F.lit(1).alias("route"))] if near is not None else [])
    return reduce(DataFrame.union, routes).groupBy("table").agg(F.min("route").alias("route"))


def expand_tables(seeds: DataFrame, relations: DataFrame, least: float = 0.7, limit: int = 15) -> DataFrame:
    """(table, hop): the seeds and their neighbours over sure relations, seeds first, ``limit`` in all."""
    near = relation_graph(relations, least).join(seeds.select("table"), "table", "left_semi").select(F.col("neighbour").alias("table"), F.lit(1).alias("hop"))
    every = seeds.select("table", F.lit(0).alias("hop")).union(near).groupBy("table").agg(F.min("hop").alias("hop"))
    return every.orderBy("hop", "table").limit(limit)


def build_context(chosen: DataFrame, chunks: DataFrame, relations: DataFrame, least: float = 0.7) -> DataFrame:
    """(kind, text): chunks of the chosen tables and the joins among them."""
    pick = chosen.select("table")
    joins = relations.where(F.col("confidence") >= least).join(pick.withColumnRenamed("table", "from_table"), "from_table", "left_semi").join(pick.withColumnRenamed("table", "to_table"), "to_table", "left_semi")
    text = F.concat(F.lit("JOIN "), F.concat_ws(".", "from_table", "from_column"), F.lit(" = "), F.concat_ws(".", "to_table", "to_column"))
    return chunks.join(pick, "table", "left_semi").select(F.lit("chunk").alias("kind"), F.col("chunk").alias("text")).union(joins.select(F.lit("join").alias("kind"), text.alias("text")))


def locate_cell(locator: DataFrame, rows: DataFrame, table: str, key: str, column: str) -> DataFrame:
    """(address, exact): the cell of a key and a column; without a known row, the column at the first row of data."""
    cell = locator.where((F.col("table") == table) & (F.col("column") == column))
    row = rows.where(F.col("key") == key).select("table", "row")
    return cell.join(row, "table", "left").select(
        F.concat("letter", F.coalesce("row", "data_start_row").cast("string")).alias("address"), F.col("row").isNotNull().alias("exact")
    )


def table_detail(columns: DataFrame, samples: DataFrame, relations: DataFrame, table: str) -> DataFrame:
    """(kind, item, detail): a table's columns with up to ten values, and its twenty surest relations from 0.6 on."""
    values = samples.where((F.col("table") == table) & (F.col("rank") <= 10)).groupBy("column").agg(F.array_join(F.sort_array(F.collect_list("value")), ",").alias("detail"))
    cols = columns.where(F.col("table") == table).join(values, "column", "left").select(F.lit("column").alias("kind"), F.col("column").alias("item"), "detail")
    rel = relation_graph(relations, 0.6).where(F.col("table") == table).orderBy(F.desc("confidence"), "join_text").limit(20)
    return cols.union(rel.select(F.lit("relation").alias("kind"), F.col("join_text").alias("item"), F.col("direction").alias("detail")))


def rank_tables(tables: DataFrame, centrality: DataFrame, community: DataFrame, seeds: list[str], limit: int = 10) -> DataFrame:
    """(table, score): 1.5 centrality / 100, 0.5 for small tables, 1 in the community of a seed."""
    mine = community.where(F.col("table").isin(*seeds)).select("community").distinct().withColumn("mine", F.lit(1.0))
    joined = tables.join(centrality, "table", "left").join(community, "table", "left").join(mine, "community", "left")
    score = F.coalesce("score", F.lit(0.0)) * 1.5 / 100 + F.when(F.col("row_count") <= 200, 0.5).otherwise(0.0) + F.coalesce("mine", F.lit(0.0))
    return joined.select("table", (F.floor(score * 10000 + 0.5) / 10000).alias("score")).orderBy(F.desc("score"), "table").limit(limit)


def seed_tables(tables: DataFrame, entities: list[str]) -> DataFrame:
    """(entity, table): tables that an entity's name begins, or whose domain it is."""
    names = tables.sparkSession.createDataFrame([(e.lower(),) for e in entities], "entity string")
    return tables.join(F.broadcast(names), F.lower("table").startswith(F.col("entity")) | (F.col("domain") == F.col("entity"))).select("entity", "table")


def chunk_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(table, change): chunks added, removed or changed between two exports."""
    b, a = before.select("table", F.col("chunk").alias("b")), after.select("table", F.col("chunk").alias("a"))
    change = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return b.join(a, "table", "full_outer").select("table", change.alias("change")).where("change is not null")


def report_recall(tables: DataFrame, columns: DataFrame, relations: DataFrame, words: str) -> DataFrame:
    """(kind, name, score): tables (1 by name, .7 begun, .3 within), columns (1, .6) and relations (.8) that a word is found in."""
    w = F.lit(words.lower())
    low = F.lower("table")
    t = tables.select(F.lit("table").alias("kind"), F.col("table").alias("name"), F.when(low == w, 1.0).when(low.startswith(w), 0.7).when(F.contains(low, w), 0.3).alias("score"))
    lc = F.lower("column")
    c = columns.select(F.lit("column").alias("kind"), F.concat_ws(".", "table", "column").alias("name"), F.when(lc == w, 1.0).when(F.contains(lc, w), 0.6).alias("score"))
    label = F.concat(F.concat_ws(".", "from_table", "from_column"), F.lit("->"), F.concat_ws(".", "to_table", "to_column"))
    r = relations.select(F.lit("relation").alias("kind"), label.alias("name"), F.when(F.contains(F.lower(label), w), 0.8).alias("score"))
    return t.union(c).union(r).where("score is not null")
