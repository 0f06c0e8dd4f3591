"""All analyses of the graph of tables in one table, and a report of it in lines of text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.store import stored
from . import graph as G

#: The sections of the report with their headings and the number of entries shown.
SECTIONS = (("cycle", "Cycles", 5), ("centrality", "Central tables", 5), ("module", "Modules", 5), ("orphan", "Tables without relations", 10), ("critical_path", "Longest chain", 1))


def analysis(nodes: DataFrame, relations: DataFrame) -> DataFrame:
    """(kind, item, score): cycles and the longest chain (score: tables in them), centrality of each table, modules (tables in them), orphans (0)."""
    part = lambda df, kind, item, score: df.select(F.lit(kind).alias("kind"), F.col(item).alias("item"), score.cast("double").alias("score"))
    modules = G.communities(nodes, relations).groupBy("community").agg(F.array_join(F.array_sort(F.collect_list("table")), ",").alias("tables"), F.count("*").alias("n"))
    parts = (
        part(G.cycles(relations), "cycle", "cycle", F.col("n_tables")),
        part(G.centrality(nodes, relations), "centrality", "table", F.col("score")),
        part(modules, "module", "tables", F.col("n")),
        part(G.orphans(nodes, relations), "orphan", "table", F.lit(0)),
        part(G.critical_path(relations), "critical_path", "path", F.col("hops") + 1),
    )
    return stored(reduce(DataFrame.union, parts), "analysis")


def summary(found: DataFrame) -> DataFrame:
    """(section, place, text): a heading with the number of entries (place 0), then the first entries, the highest scores first."""
    named = found.sparkSession.createDataFrame([(k, s, h, n) for s, (k, h, n) in enumerate(SECTIONS)], "kind string, section int, heading string, most int")
    w = Window.partitionBy("kind").orderBy(F.desc("score"), "item")
    first = found.withColumn("place", F.row_number().over(w)).join(named, "kind").where(F.col("place") <= F.col("most"))
    text = F.when(F.col("kind") == "orphan", F.col("item")).otherwise(F.concat(F.col("item"), F.lit(" ("), F.regexp_replace(F.col("score").cast("string"), r"\.0$", ""), F.lit(")")))
    heads = named.join(found.groupBy("kind").agg(F.count("*").alias("n")), "kind", "left").select("section", F.lit(0).alias("place"), F.concat("heading", F.lit(": "), F.coalesce("n", F.lit(0))).alias("text"))
    return heads.union(first.select("section", "place", text.alias("text")))
