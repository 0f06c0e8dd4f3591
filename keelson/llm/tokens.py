"""Token counts kept as additive totals, maintained by signed deltas.

A batch holds signed rows: an insert adds a document's counts, a delete takes them
away, a revision does both.  It is summed by source, language and tokenizer version before it is
stored, under its batch id; a batch that is there already is not stored again, so a
commit can be repeated after any failure.  Totals are the sum over batches; a fold stores the sum so far,
so that they need not be read again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import Workspace

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_bytes")
COUNTED = "doc_id bigint, source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, n_bytes bigint"
STORED = "batch_id string, source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, n_bytes bigint"

_encodings: dict[str, object] = {}


def _encoding(path: str):
    """The byte-level vocabulary in a .tiktoken file, once per worker."""
    if path not in _encodings:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def _counted(path: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path).encode_ordinary
        for batch in batches:
            texts = batch.column("text")
            tokens = np.fromiter((len(encode(t.as_py())) for t in texts), np.int64, len(texts))
            columns = {k: batch.column(k) for k in ("doc_id", "source", "lang")} | {
                "tokenizer": pa.array([version] * len(texts), pa.string()),
                "n_docs": pa.array(np.ones(len(texts), np.int64)),
                "n_tokens": pa.array(tokens),
                "n_bytes": pa.compute.cast(pa.compute.binary_length(texts), pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def count_tokens(docs: DataFrame, vocabulary: str, version: str) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_docs = 1, n_tokens, n_bytes) of every document.

    Null texts count as empty ones; null or missing source and lang stay null.
    """
    Workspace(docs.sparkSession, "tokens")
    column = lambda k, t: (F.col(k) if k in docs.columns else F.lit(None)).cast(t).alias(k)
    docs = docs.select(column("doc_id", "bigint"), column("source", "string"), column("lang", "string"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return docs.mapInArrow(_counted(vocabulary, version), COUNTED)


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Counts as inserts (1) or deletes (-1)."""
    return counts.select(*KEYS, *((F.col(c) * sign).alias(c) for c in SUMS))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """The deltas that replace the counts of some documents."""
    return signed(before, -1).unionByName(signed(after, 1))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*(F.sum(c).cast("bigint").alias(c) for c in SUMS))


def _literal(path: str) -> str:
    """A path in which no character is a wildcard."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


class Rollup:
    """Totals in a folder: a sub-folder for each batch, in it one for each attempt at storing it, and folds of many batches.

    What Spark has written whole bears its _SUCCESS mark, and only that is read.  Of several attempts at one
    batch the first to be finished counts, so writers that meet do not mix and nothing is renamed.
    A batch id stands for one content.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _finished(self, pattern: str) -> list[str]:
        """Folders that bear the mark, the first to be finished first."""
        marks = self._fs.globStatus(self._path(f"{_literal(self.path)}/{pattern}/*/_SUCCESS")) or ()
        return [folder for _, folder in sorted((m.getModificationTime(), m.getPath().getParent().toString()) for m in marks)]

    def _stored(self) -> dict[str, str]:
        """The folder of each batch."""
        out: dict[str, str] = {}
        for folder in self._finished("batch-*"):
            out.setdefault(folder.rsplit("/", 2)[1].removeprefix("batch-"), folder)
        return out

    def batches(self) -> list[str]:
        return sorted(self._stored())

    def _write(self, rows: DataFrame, place: str) -> None:
        folder = f"{self.path}/{place}/{uuid.uuid4().hex}"
        rows.select("batch_id", *KEYS, *SUMS).write.parquet(folder)
        if not self._fs.exists(self._path(f"{folder}/_SUCCESS")):
            raise ValueError("mapreduce.fileoutputcommitter.marksuccessfuljobs must be on")

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Stores a batch; False if it is there already.  A batch shows up whole or not at all."""
        if not batch_id or "/" in batch_id:
            raise ValueError("a batch id must be a file name")
        if batch_id in self._stored():
            return False
        self._write(_summed(deltas).withColumn("batch_id", F.lit(batch_id)), f"batch-{batch_id}")
        return True

    def _rows(self) -> tuple[DataFrame, list[str]]:
        """The rows of the last fold and of the batches that it does not cover, and the ids of both."""
        read = lambda folders: self.spark.read.schema(STORED).parquet(*map(_literal, folders))
        rows, stored, covered = self.spark.createDataFrame([], STORED), self._stored(), set()
        if last := self._finished("fold")[-1:]:
            rows = read(last)
            covered = {r["batch_id"] for r in rows.where("batch_id is not null").select("batch_id").collect()}  # ids, as in the listing
        if new := [folder for b, folder in stored.items() if b not in covered]:
            rows = rows.unionByName(read(new))
        return rows, sorted(covered | set(stored))

    def fold(self) -> None:
        """Stores the sums of all batches so far with their ids: later totals read them and newer batches only."""
        rows, ids = self._rows()
        names = self.spark.createDataFrame([(b,) for b in ids], "batch_id string")
        nothing = [F.lit(None).cast("string").alias(k) for k in KEYS] + [F.lit(0).cast("bigint").alias(c) for c in SUMS]
        self._write(_summed(rows).withColumn("batch_id", F.lit(None).cast("string")).unionByName(names.select("batch_id", *nothing)), "fold")

    def totals(self) -> DataFrame:
        """One row per source, language and tokenizer version whose sums are not all zero; null keys are groups of their own."""
        some = reduce(lambda a, b: a | b, (F.col(c) != 0 for c in SUMS))
        return _summed(self._rows()[0]).where(some)


def token_totals(docs: DataFrame, labels: DataFrame, vocabulary: str, newer: str, version: str, newer_version: str) -> DataFrame:
    """Totals after four commits and a fold: all documents, withdrawal of toxic ones, recount of other languages, and a repeat.

    ``load`` inserts every document; ``withdraw`` deletes those labelled toxic; ``recount`` moves
    what remains of other languages than English (lang not null) to the newer tokenizer version;
    then ``load`` is committed again, which changes nothing.  Rows without doc_id are never
    withdrawn; rows that share one are withdrawn together.  An empty table has no totals.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "rollup")
    toxic = labels.where("toxic = 1").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    load = work.put(count_tokens(docs, vocabulary, version), "load")
    other = F.col("lang").isNotNull() & (F.col("lang") != "en")
    newly = count_tokens(docs.where(other), newer, newer_version).join(toxic, "doc_id", "left_anti")  # counts are joined, not texts
    rollup = Rollup(spark, f"{work.root}/totals")
    rollup.commit("load", signed(load, 1))
    rollup.commit("withdraw", signed(load.join(toxic, "doc_id", "left_semi"), -1))
    rollup.fold()
    rollup.commit("recount", revised(load.where(other).join(toxic, "doc_id", "left_anti"), newly))
    rollup.commit("load", signed(load, 1))
    return rollup.totals()
