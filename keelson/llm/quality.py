"""Quality classifier: histogram gradient-boosted trees over document statistics.

Features are worked out by Spark tasks for all documents; the trees are fitted on a
bounded sample of labelled rows, flattened into arrays, and applied to all documents by
numpy, a level of a tree at a time for all rows of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .docstats import FEATURES, features
from .textbatch import pieces
from .workspace import Workspace

#: The most labelled rows that a fit takes, by the hash of their id.
FIT_ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAF = 80, 4, 64, 0.15, 1.0, 20


@dataclass
class Forest:
    """All trees in one set of arrays; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        row = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Trees for P(y = 1); without rows, or with one class, a constant."""
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    start = float(np.log(rate / (1 - rate)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
        score = np.full(len(y), start)
        for _ in range(TREES):
            p = 1.0 / (1.0 + np.exp(-score))
            roots.append(_grow(nodes, binned, edges, p - y, p * (1 - p), score))
    arrays = [np.array(nodes[k], t) for k, t in (("feature", np.int64), ("threshold", float), ("left", np.int64), ("right", np.int64), ("value", float))]
    return Forest(np.array(roots, np.int64), *arrays, start, DEPTH)


def _grow(nodes: dict[str, list], binned: np.ndarray, edges: list, g: np.ndarray, h: np.ndarray, score: np.ndarray) -> int:
    """Adds one tree to the nodes and its values to the scores; -> its root."""
    width = binned.shape[1]

    def add(rows: np.ndarray, depth: int) -> int:
        at = len(nodes["value"])
        for k, v in (("feature", 0), ("threshold", np.inf), ("left", at), ("right", at), ("value", 0.0)):
            nodes[k].append(v)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None, None)
        if depth < DEPTH and len(rows) >= 2 * LEAF:
            cell = (binned[rows] + np.arange(width) * BINS).ravel()
            sums = [np.bincount(cell, np.repeat(v, width), minlength=width * BINS).reshape(width, BINS).cumsum(axis=1) for v in (g[rows], h[rows], np.ones(len(rows)))]
            left_g, left_h, left_n = sums
            gain = left_g**2 / (left_h + RIDGE) + (total_g - left_g) ** 2 / (total_h - left_h + RIDGE) - total_g**2 / (total_h + RIDGE)
            gain[(left_n < LEAF) | (len(rows) - left_n < LEAF)] = 0
            j, k = np.unravel_index(int(gain.argmax()), gain.shape)
            if gain[j, k] > best[0]:
                best = (gain[j, k], j, k)
        if best[1] is None:
            value = -RATE * total_g / (total_h + RIDGE)
            nodes["value"][at] = float(value)
            score[rows] += value
            return at
        _, j, k = best
        nodes["feature"][at], nodes["threshold"][at] = int(j), float(edges[j][k])
        below = binned[rows, j] <= k
        nodes["left"][at] = add(rows[below], depth + 1)
        nodes["right"][at] = add(rows[~below], depth + 1)
        return at

    return add(np.arange(len(g)), 0)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, texts in pieces(batch.column("text")):
            x = features(texts)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), values], names=["doc_id", "x"])


def _scored(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            columns = {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(forest.scores(x))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def held_out(doc_id) -> F.Column:
    """Rows of the fold that is never learned from: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1) and predicted (0 or 1).

    Labels (doc_id, quality) are learned from only where held_out is false and neither
    column is null; at most ``fit_rows`` of them, by the hash of their id, and again of the
    rows with those ids.  Only
    the text enters a score.  Null and empty texts get the score of a row of zeros;
    without labels, or with one class, all scores are the smoothed share of that class.
    Rows keep their doc_id, null or repeated (null: not held out, never learned from);
    other columns are ignored; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession, "quality")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    measured = work.put(texts.mapInArrow(_measured, "doc_id bigint, x array<double>").withColumn("held_out", held_out("doc_id")), "features")
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "doc_id is not null and quality is not null"
    )
    chosen = known.where(~held_out("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fit_rows)
    rows = measured.join(chosen, "doc_id").orderBy(F.xxhash64("doc_id", "x", "quality"), "doc_id", "quality").limit(fit_rows).orderBy("doc_id", "quality").select("x", "quality").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, len(FEATURES))
    forest = fit(x, (rows.column("quality").to_numpy() > 0).astype(float))
    scored = measured.mapInArrow(_scored(forest), "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
