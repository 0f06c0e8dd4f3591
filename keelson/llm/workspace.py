"""Tables that cut lineage, in the folder that the cluster shares.

``spark.checkpoint.dir`` names the folder; only where it is unset and Spark runs on one
machine (tests) is a temporary one made.  Spark is told to drop a query's shuffle files
when the query ends, so the disk in use is that of one step, not of all.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback: dict[str, str] = {}
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Whole texts travel in Arrow batches, which hold 2 GB at most: for the session, as plans run after the operator has returned.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20)}


class Workspace:
    def __init__(self, spark: SparkSession, label: str):
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = _fallback.setdefault("dir", tempfile.mkdtemp(prefix="keelson-"))
        self.spark, self.root = spark, f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
        for name, value in BATCHES.items():
            spark.conf.set(name, value)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """df as written; the stages behind it are not run again."""
        path, before = f"{self.root}/{name}", self.spark.conf.get(CLEAN, "false")
        self.spark.conf.set(CLEAN, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            self.spark.conf.set(CLEAN, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Removes a table that no later step reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: what the number of blocks and buckets is derived from."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]
