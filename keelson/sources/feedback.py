"""What people said of relations, kept as a table that only grows: the last word on a relation counts."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SAID = "relation_key string, status string, at double"


def relation_key(from_table: str, from_column: str, to_table: str, to_column: str) -> Column:
    """'a.b->c.d' of the columns with these names."""
    return F.concat(F.concat_ws(".", from_table, from_column), F.lit("->"), F.concat_ws(".", to_table, to_column))


def say(relations: DataFrame, status: str, path: str, at: float | None = None) -> None:
    """Adds that these relations are confirmed or rejected, as one more part of the table."""
    if status not in ("confirmed", "rejected"):
        raise ValueError(f"no such status: {status}")
    key = relation_key("from_table", "from_column", "to_table", "to_column")
    when = F.lit(time.time() if at is None else float(at))
    relations.select(key.alias("relation_key"), F.lit(status).alias("status"), when.alias("at")).write.mode("append").parquet(path)


def said(spark: SparkSession, path: str) -> DataFrame:
    """(relation_key, status): the last word on each relation, so none is both confirmed and rejected; of words of one moment, rejected."""
    rows = spark.read.schema(SAID).parquet(path)
    return rows.groupBy("relation_key").agg(F.max_by("status", F.struct("at", "status")).alias("status"))


def check(relations: DataFrame, feedback: DataFrame) -> DataFrame:
    """The relations with their status: confirmed, rejected or unknown."""
    keyed = relations.withColumn("relation_key", relation_key("from_table", "from_column", "to_table", "to_column"))
    return keyed.join(feedback.select("relation_key", "status"), "relation_key", "left").withColumn("status", F.coalesce("status", F.lit("unknown"))).drop("relation_key")
