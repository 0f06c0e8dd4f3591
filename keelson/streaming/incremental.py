"""Rebuilds when sources change: listings compared, change log, and a stream that triggers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import discovery as D
from ..operators.profile import schema_diff


def file_changes(before: DataFrame, after: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """(path, change): files new, updated, unchanged or deleted between two listings (path, modified)."""
    b, a = before.select("path", F.col("modified").alias("b")), after.select("path", F.col("modified").alias("a"))
    apart = F.abs(F.col("a").cast("double") - F.col("b").cast("double")) > tolerance
    change = F.when(F.col("b").isNull(), "new").when(F.col("a").isNull(), "deleted").when(apart, "updated").otherwise("unchanged")
    return b.join(a, "path", "full_outer").select("path", change.alias("change"))


def changelog(before: DataFrame, after: DataFrame) -> DataFrame:
    """(table, change_type, details): tables added and removed, and columns that drifted."""
    b, a = before.select("table").distinct(), after.select("table").distinct()
    added = a.join(b, "table", "left_anti").select("table", F.lit("table_added").alias("change_type"), F.lit("").alias("details"))
    removed = b.join(a, "table", "left_anti").select("table", F.lit("table_removed").alias("change_type"), F.lit("").alias("details"))
    drift = schema_diff(before, after).groupBy("table").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "change", "column"))), "; ").alias("details"))
    return added.union(removed).union(drift.select("table", F.lit("schema_changed").alias("change_type"), "details"))


def refreshed(known: DataFrame, columns: DataFrame, tables: DataFrame, norm: DataFrame, candidates: DataFrame, changed: tuple[str, ...]) -> DataFrame:
    """Unpruned containment and naming relations after some tables changed: those that touch no changed table, and fresh ones.

    Fusion and pruning come after, on all of them, so the outcome equals that of a full build.
    """
    kept = known.where(~(F.col("from_table").isin(*changed) | F.col("to_table").isin(*changed)))
    found = D.containment(D.adjusted(D.scores(D.overlaps(norm, candidates, changed), candidates)))
    return kept.unionByName(found).unionByName(D.naming(columns, tables, norm, changed=changed))


def keep_fresh(spark: SparkSession, refresh: Callable[[], DataFrame], checkpoint: str, seconds: int = 3) -> StreamingQuery:
    """Calls ``refresh`` (as ``Library.refresh``) again and again: listings show changed and deleted files, which a file source does not report.

    A call that fails ends the stream; the version before it stays, and a new stream goes on from there.
    """
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    return ticks.writeStream.foreachBatch(lambda _, __: refresh()).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def on_change(spark: SparkSession, folder: str, schema: str, rebuild: Callable[[list[str]], None], checkpoint: str, pattern: str = "*.parquet") -> StreamingQuery:
    """Calls ``rebuild`` with the files that arrived, at most every three seconds.

    The file source sees new files only; deletions and changes need ``file_changes``.
    """
    files = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder).select(F.input_file_name().alias("path"))

    def each(batch: DataFrame, _: int) -> None:
        paths = [r["path"] for r in batch.distinct().collect()]  # names of files, one row each
        if paths:
            rebuild(sorted(paths))

    return files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime="3 seconds").start()
