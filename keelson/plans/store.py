"""Tables that cut lineage, in the folder that the cluster shares (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder; a temporary one only where none is set, as in tests on one machine."""
    base, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not base and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (base or _local.setdefault("dir", tempfile.mkdtemp(prefix="keelson-"))).rstrip("/")


def stored(df: DataFrame, name: str = "part") -> DataFrame:
    """df as written once: later plans start from a scan and stay small, and lost executors take nothing with them."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
