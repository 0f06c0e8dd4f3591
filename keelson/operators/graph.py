"""Analytics of the graph of tables: nodes (table) and relations.

The graph has a node per table, so iterations are short joins; each is unrolled
lazily for a stated number of rounds, or cut by a stored table where it is long or runs until nothing changes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.store import stored


def links(relations: DataFrame) -> DataFrame:
    return relations.select("from_table", "to_table").distinct()


def orphans(nodes: DataFrame, relations: DataFrame) -> DataFrame:
    """Tables without a relation."""
    ends = relations.select(F.col("from_table").alias("table")).union(relations.select(F.col("to_table").alias("table")))
    return nodes.join(ends, "table", "left_anti")


def degrees(nodes: DataFrame, relations: DataFrame) -> DataFrame:
    ends = relations.select(F.col("from_table").alias("table")).union(relations.select(F.col("to_table").alias("table")))
    return nodes.join(ends.groupBy("table").agg(F.count("*").alias("degree")), "table", "left").select("table", F.coalesce("degree", F.lit(0)).cast("bigint").alias("degree"))


def centrality(nodes: DataFrame, relations: DataFrame, rounds: int = 100, damping: float = 0.85) -> DataFrame:
    """PageRank without redistribution from sinks, scaled so that the largest is 100, in two decimals.

    Ranks are sums over walks, so rounds can be grouped: the lineage is cut into the shared folder every ten.
    """
    edges = links(relations)
    out = edges.groupBy("from_table").agg(F.count("*").alias("n"))
    n = nodes.count()
    if not n:
        return nodes.select("table", F.lit(0.0).alias("score"))
    weighted = cut(edges.join(out, "from_table"))
    base = cut(nodes)
    ranks = base.select("table", F.lit(1.0 / n).alias("rank"))
    for k in range(rounds):
        given = weighted.join(ranks, weighted["from_table"] == ranks["table"]).groupBy("to_table").agg(F.sum(F.col("rank") / F.col("n")).alias("given"))
        ranks = base.join(given, base["table"] == given["to_table"], "left").select(base["table"], (F.lit((1 - damping) / n) + damping * F.coalesce("given", F.lit(0.0))).alias("rank"))
        if k % 10 == 9:
            ranks = cut(ranks)
    top = ranks.agg(F.max("rank").alias("top"))
    return ranks.crossJoin(F.broadcast(top)).select("table", (F.floor(F.col("rank") / F.col("top") * 10000 + 0.5) / 100).alias("score"))


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage."""
    return stored(df, "graph")


def paths(relations: DataFrame, hops: int, least: float, source: str | None = None, ends: tuple[str, str] | None = None) -> DataFrame:
    """(src, dst, hops, confidence, path): the shortest undirected join path of each pair, up to ``hops`` relations.

    ``source`` is the table that paths start from; with ``ends`` they start from tables with the first word in their name,
    and end at the first table that has the second.  Of equally short ones the path of the highest product of confidences, then the first in order of text.
    """
    strong = relations.where(F.col("confidence") >= least)
    text = F.concat(F.concat_ws(".", "from_table", "from_column"), F.lit("="), F.concat_ws(".", "to_table", "to_column"))
    ahead = strong.select(F.col("from_table").alias("x"), F.col("to_table").alias("y"), "confidence", text.alias("step"))
    back = strong.select(F.col("to_table").alias("x"), F.col("from_table").alias("y"), "confidence", text.alias("step"))
    w = Window.partitionBy("x", "y").orderBy(F.desc("confidence"), "step")
    edges = ahead.union(back).where("x <> y").withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    first = edges if source is None else edges.where(F.col("x") == source)
    going, reached = F.lit(True), F.lit(True)
    if ends is not None:
        first = first.where(F.contains(F.lower("x"), F.lit(ends[0].lower())))
        reached = F.contains(F.lower("dst"), F.lit(ends[1].lower()))
        going = ~reached
    level = first.select(F.col("x").alias("src"), F.col("y").alias("dst"), "confidence", F.col("step").alias("path"), F.array("x", "y").alias("seen"))
    levels = [level.withColumn("hops", F.lit(1))]
    for k in range(2, hops + 1):
        nxt = edges.select("x", F.col("y").alias("to"), F.col("confidence").alias("c"), "step")
        level = level.where(going).join(nxt, F.col("dst") == F.col("x")).where(~F.array_contains("seen", F.col("to"))).select(
            "src", F.col("to").alias("dst"), (F.col("confidence") * F.col("c")).alias("confidence"), F.concat_ws(" AND ", "path", "step").alias("path"), F.array_append("seen", F.col("to")).alias("seen")
        )
        levels.append(level.withColumn("hops", F.lit(k)))
    every = reduce(DataFrame.union, (x.select("src", "dst", "hops", "confidence", "path") for x in levels)).where(reached)
    w = Window.partitionBy("src", "dst").orderBy("hops", F.desc("confidence"), "path")
    return every.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def cycles(relations: DataFrame, length: int = 4) -> DataFrame:
    """(cycle, n_tables): elementary cycles, each once, from its smallest table on.

    All of up to ``length`` tables, and for each relation that is on longer ones only a shortest of them, however long.
    """
    edges = links(relations).where("from_table <> to_table").select(F.col("from_table").alias("x"), F.col("to_table").alias("y"))
    walk = edges.where("x < y").select(F.col("x").alias("start"), F.col("y").alias("end"), F.array("x", "y").alias("seen"))
    found = []
    for k in range(2, length + 1):
        closing = walk.join(edges, (walk["end"] == edges["x"]) & (walk["start"] == edges["y"]))
        found.append(closing.select(F.array_join("seen", ">").alias("cycle"), F.lit(k).alias("n_tables")))
        walk = walk.join(edges, walk["end"] == edges["x"]).where((F.col("y") > F.col("start")) & ~F.array_contains("seen", F.col("y"))).select(
            "start", F.col("y").alias("end"), F.array_append("seen", F.col("y")).alias("seen")
        )
    return reduce(DataFrame.union, [*found, _long_cycles(edges, length)])


def _long_cycles(edges: DataFrame, length: int) -> DataFrame:
    """A shortest cycle of each edge (x, y) that is on none of up to ``length`` tables."""
    edges, before = cut(edges), -1
    while (n := edges.count()) != before:  # tables without a way in or out are on no cycle
        inner = edges.join(edges.select(F.col("y").alias("x")).distinct(), "x", "left_semi")
        edges, before = cut(inner.join(edges.select(F.col("x").alias("y")).distinct(), "y", "left_semi").select("x", "y")), n
    level = edges.groupBy("y").agg(F.array(F.first("y")).alias("path")).select(F.col("y").alias("src"), F.col("y").alias("end"), "path")
    level = cut(level)
    levels = [level]
    while not level.isEmpty():
        seen = reduce(DataFrame.union, (x.select("src", "end") for x in levels))
        ahead = level.join(edges, level["end"] == edges["x"]).select("src", F.col("y").alias("end"), F.array_append("path", F.col("y")).alias("path"))
        level = cut(ahead.groupBy("src", "end").agg(F.min("path").alias("path")).join(seen, ["src", "end"], "left_anti"))
        levels.append(level)
    back = reduce(DataFrame.union, levels).select(F.col("src").alias("y"), F.col("end").alias("x"), "path")
    at = F.array_position("path", F.array_min("path")).cast("int")
    turned = F.concat(F.slice("path", at, F.size("path")), F.slice("path", 1, at - 1))
    closed = edges.join(back, ["x", "y"]).where(F.size("path") > length).select(turned.alias("path")).distinct()
    return closed.select(F.array_join("path", ">").alias("cycle"), F.size("path").alias("n_tables"))


def acyclic(relations: DataFrame, least: float = 0.5) -> DataFrame:
    """(from_table, to_table, confidence): the surest relation of each two tables, less the least sure one of every cycle.

    Of equally sure ones the first by name is the surer.  An edge goes if surer ones alone lead from its end back to its start,
    so what is left has no cycle.  The walk is a join per step, of edges with the tables reached.
    """
    best = F.max_by(F.struct("from_table", "to_table", "confidence"), F.struct("confidence", F.col("from_table") < F.col("to_table"))).alias("b")
    rows = relations.where((F.col("confidence") >= least) & (F.col("from_table") != F.col("to_table")))
    rows = rows.groupBy(F.least("from_table", "to_table").alias("k1"), F.greatest("from_table", "to_table").alias("k2")).agg(best).select("b.*")
    order = F.struct((-F.col("confidence")).alias("c"), "from_table", "to_table")
    edges = cut(rows.withColumn("order", order))
    level = cut(edges.select("from_table", "to_table", "order", F.col("to_table").alias("at")))
    levels = [level]
    step = edges.select(F.col("from_table").alias("x"), F.col("to_table").alias("y"), F.col("order").alias("o"))
    while not level.isEmpty():
        seen = reduce(DataFrame.union, (x.select("from_table", "to_table", "at") for x in levels))
        ahead = level.join(step, (F.col("at") == F.col("x")) & (F.col("o") < F.col("order")))
        level = cut(ahead.select("from_table", "to_table", "order", F.col("y").alias("at")).distinct().join(seen, ["from_table", "to_table", "at"], "left_anti"))
        levels.append(level)
    closed = reduce(DataFrame.unionByName, levels).where("at = from_table").select("from_table", "to_table").distinct()
    return edges.drop("order").join(closed, ["from_table", "to_table"], "left_anti")


def critical_path(relations: DataFrame) -> DataFrame:
    """(path, hops): the longest chain of relations among tables that are on no cycle and behind none."""
    edges = links(relations).where("from_table <> to_table").select(F.col("from_table").alias("x"), F.col("to_table").alias("y"))
    edges = cut(edges)
    ends = edges.select(F.col("x").alias("t")).union(edges.select(F.col("y").alias("t"))).distinct()
    # Tables all of whose sources are settled become settled; those that never do are on or behind a cycle.
    settled, n, before = None, 0, -1
    while n != before:
        open_ = edges if settled is None else edges.join(settled.withColumnRenamed("t", "x"), "x", "left_anti")
        settled, before = cut(ends.join(open_.select(F.col("y").alias("t")).distinct(), "t", "left_anti")), n
        n = settled.count()
    inside = edges.join(settled.withColumnRenamed("t", "x"), "x", "left_semi").join(settled.withColumnRenamed("t", "y"), "y", "left_semi")
    best = settled.select("t", F.array("t").alias("path"))
    level, found = best, [best]
    while True:
        w = Window.partitionBy("t").orderBy(F.array_join("path", ">"))
        level = level.join(inside, level["t"] == inside["x"]).select(F.col("y").alias("t"), F.array_append("path", F.col("y")).alias("path"))
        level = cut(level.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r"))
        if level.isEmpty():
            break
        found.append(level)
    every = reduce(DataFrame.union, found).select(F.array_join("path", ">").alias("path"), (F.size("path") - 1).alias("hops"))
    return every.orderBy(F.desc("hops"), "path").limit(1)


def communities(nodes: DataFrame, relations: DataFrame, rounds: int = 100) -> DataFrame:
    """(table, community): asynchronous label propagation, ties to the smallest label; groups of two or more, named by their first table.

    Tables take the most frequent label of their neighbours (those that refer to them and those they refer to; one that does both counts twice) one after the
    other, in order of the MD5 of their names.  Tables of one level (no neighbour comes before, or all that do have lower levels)
    are no neighbours of each other, so a whole level is done at once with the same outcome.  A change never lowers the
    number of neighbours that agree, and lowers a label where it leaves it as it is, so a round without changes comes by itself.
    """
    edges = links(relations).where("from_table <> to_table")
    both = edges.select(F.col("from_table").alias("x"), F.col("to_table").alias("y")).union(edges.select(F.col("to_table").alias("x"), F.col("from_table").alias("y")))
    both = cut(both.join(nodes.select(F.col("table").alias("x")), "x", "left_semi").join(nodes.select(F.col("table").alias("y")), "y", "left_semi"))
    before = cut(both.where(F.struct(F.md5("y"), "y") < F.struct(F.md5("x"), "x")))
    open_, levels = both.select("x").distinct(), []
    while not open_.isEmpty():
        waits = before.join(open_.select(F.col("x").alias("y")), "y", "left_semi").select("x").distinct()
        free = open_.join(waits, "x", "left_anti")
        levels.append(cut(both.join(free, "x", "left_semi")))
        open_ = cut(open_.join(waits, "x", "left_semi"))
    labels = cut(nodes.select("table", F.col("table").alias("label")))
    for _ in range(rounds):
        start = labels
        for level in levels:
            votes = level.join(labels, level["y"] == labels["table"]).groupBy("x", "label").agg(F.count("*").alias("n"))
            new = votes.groupBy("x").agg(F.min(F.struct(-F.col("n"), F.col("label"))).alias("b")).select(F.col("x").alias("table"), F.col("b.label").alias("new"))
            labels = cut(labels.join(new, "table", "left").select("table", F.coalesce("new", "label").alias("label")))
        if labels.join(start, ["table", "label"], "left_anti").isEmpty():
            break
    size = Window.partitionBy("label")
    named = labels.withColumn("n", F.count("*").over(size)).withColumn("community", F.min("table").over(size))
    return named.where("n > 1").select("table", "community")
