"""Hard-negative mining with one-dimensional distance keys.

A further coordinate, sqrt(M - |v|**2) for the largest squared norm M, makes all vectors equally long, so
the largest inner products with an anchor (its own coordinate is 0) are the least distances: d**2 = |q|**2 + M - 2 * score.
Each vector is keyed by its nearest pivot and its distance to it, and the rows are stored in order of
(pivot, distance), in blocks that cover an interval of keys.  A vector within R of an anchor that is D away from a
pivot has its key in [D - R, D + R].  R comes from a sample: what a search finds
there bounds the k-th score from below, so the blocks whose interval is met hold the whole answer.
A search takes its blocks from the anchor's key outwards, annulus by annulus, and leaves out those whose least distance can
no longer reach the k-th score that it has; all scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .workspace import Workspace

POSITIVES, NEGATIVES = 5, 10
#: Rows, by a hash of their id, on which pivots are fitted and from which first bounds come; at most as many pivots.
SAMPLE, PIVOTS, ROUNDS = 8192, 64, 6
#: Vectors of a block, anchors of a block, blocks that one task searches for one block of anchors, blocks that a salt of the interval join stands for.
BLOCK, ANCHORS, SLICE, SALTED = 1024, 256, 32, 4096
#: Scores are below this, so that 90 times a score fits in 64 bits.
LARGEST = 10**17
INDEXED = "pivot int, distance double, vec_id bigint, label int, vector binary"
BLOCKS = "pivot int, low double, high double, n int, ids binary, labels binary, vectors binary"
_NONE = np.iinfo(np.int64).min


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    if not a.size or not b.size or int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


class Space:
    """The pivots, and distances to them."""

    def __init__(self, sample: np.ndarray, largest: int):
        self.largest, self.slack = float(largest), 1e-6 * float(largest) ** 0.5 + 1e-9
        points = self.augmented(sample)
        rng = np.random.default_rng(3)
        pivots = points[rng.choice(len(points), min(PIVOTS, max(1, len(points) // 16)), replace=False)]
        for _ in range(ROUNDS):
            nearest = self._between(points, pivots).argmin(1)
            sums = np.zeros_like(pivots)
            np.add.at(sums, nearest, points)
            n = np.bincount(nearest, minlength=len(pivots))
            pivots = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], pivots)
        self.pivots = pivots

    def augmented(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors.astype(np.float64)
        return np.column_stack((x, np.sqrt(np.maximum(self.largest - (x * x).sum(1), 0.0))))

    @staticmethod
    def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0.0))

    def keys(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each vector and the distance to it."""
        d = self._between(self.augmented(vectors), self.pivots)
        nearest = d.argmin(1)
        return nearest, d[np.arange(len(d)), nearest]

    def of_anchors(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance of each anchor (rows) from each pivot, and the squared norm of each."""
        x = np.column_stack((vectors.astype(np.float64), np.zeros(len(vectors))))
        return self._between(x, self.pivots), (x * x).sum(1)

    def radius(self, norms: np.ndarray, score: np.ndarray) -> np.ndarray:
        """How far away a vector of at least this score can be."""
        return np.where(score == _NONE, np.inf, np.sqrt(np.maximum(norms + self.largest - 2.0 * score, 0.0)) + self.slack)


def _matrix(raw: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(raw, np.int32).reshape(-1, dims)


def _keyed(space: Space, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(batch.num_rows, dims)
            pivot, distance = space.keys(vectors)
            columns = [pa.array(pivot, pa.int32()), pa.array(distance), batch.column("vec_id"), batch.column("label"), pa.array([row.tobytes() for row in vectors], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in INDEXED.split(", ")])

    return run


def _packed(most: int):
    """Rows in order of (pivot, distance) as blocks of one pivot."""

    def block(rows: pa.Table) -> dict:
        distance = rows.column("distance").to_numpy()
        return {
            "pivot": rows.column("pivot")[0].as_py(), "low": float(distance[0]), "high": float(distance[-1]), "n": rows.num_rows,
            "ids": rows.column("vec_id").to_numpy().astype(np.int64).tobytes(), "labels": rows.column("label").to_numpy().astype(np.int32).tobytes(),
            "vectors": b"".join(rows.column("vector").to_pylist()),
        }

    schema = pa.schema([("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("n", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            while held.num_rows:
                pivot = held.column("pivot").to_numpy()
                same = int(np.searchsorted(pivot, pivot[0], "right"))
                if same == held.num_rows and same < most:
                    break
                n = min(same, most)
                yield pa.RecordBatch.from_pylist([block(held.slice(0, n))], schema)
                held = held.slice(n)
        if held is not None and held.num_rows:
            yield pa.RecordBatch.from_pylist([block(held)], schema)

    return run


class _Anchors:
    """A block of anchors with the targets of each: scores from lo to hi."""

    def __init__(self, row: dict, dims: int, space: Space):
        self.ids, self.labels, self.vectors = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_labels"], np.int32), _matrix(row["q_vectors"], dims)
        n = len(self.ids)
        self.lo, self.hi = (np.frombuffer(row[c], np.int64).reshape(n, -1) for c in ("lo", "hi"))
        self.least = np.frombuffer(row["least"], np.int64).reshape(n, -1) if row.get("least") is not None else self.lo
        self.far, self.norms = space.of_anchors(self.vectors)

    def allowed(self, which: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool) -> np.ndarray:
        alike = labels[None] == self.labels[which, None]
        return (alike if same else ~alike) & (ids[None] != self.ids[which, None])


def _bounded(space: Space, dims: int, k: int, same: bool, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
    """Adds ``least``: the k-th score that the sample has for a target, a lower bound of that of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                anchors = _Anchors(row, dims, space)
                score, allowed = _dot(anchors.vectors, vectors), anchors.allowed(np.arange(len(anchors.ids)), ids, labels, same)
                least = anchors.lo.copy()
                for j in range(least.shape[1]):
                    fits = np.where(allowed & (score >= anchors.lo[:, j, None]) & (score <= anchors.hi[:, j, None]), score, _NONE)
                    if fits.shape[1] >= k:
                        least[:, j] = np.maximum(least[:, j], np.partition(fits, -k, axis=1)[:, -k])
                out.append(least.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "least"])

    return run


def _intervals(space: Space, dims: int):
    """(q_block, pivot, begin, end, near, beyond): the keys that a block of anchors asks a pivot for, and those of the anchors themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                anchors = _Anchors(row, dims, space)
                least = np.where(anchors.hi >= anchors.lo, anchors.least, np.iinfo(np.int64).max)
                some = (anchors.hi >= anchors.lo).any(1)
                if not some.any():
                    continue
                far, radius = anchors.far[some], space.radius(anchors.norms[some], least[some].min(1))
                pivots = far.shape[1]
                columns = [np.full(pivots, row["q_block"]), np.arange(pivots, dtype=np.int32), (far - radius[:, None]).min(0), (far + radius[:, None]).max(0), far.min(0), far.max(0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["q_block", "pivot", "begin", "end", "near", "beyond"])

    return run


class _Search:
    """The best rows of each target of a block of anchors so far."""

    def __init__(self, row: dict, dims: int, space: Space, k: int, same: bool):
        self.anchors, self.space, self.dims, self.k, self.same = _Anchors(row, dims, space), space, dims, k, same
        n, targets = self.anchors.lo.shape
        self.score, self.id = np.full((n, targets, k), _NONE), np.zeros((n, targets, k), np.int64)

    def see(self, row: dict) -> None:
        anchors, space = self.anchors, self.space
        far = anchors.far[:, row["pivot"]]
        near = np.maximum(np.maximum(row["low"] - far, far - row["high"]) - space.slack, 0.0)
        most = (anchors.norms + space.largest - near * near) / 2 + 1
        fewest = (anchors.norms + space.largest - (far + row["high"] + space.slack) ** 2) / 2 - 1
        # What has k rows already is certified against all that is farther away.
        needed = np.maximum(anchors.least, self.score[:, :, -1])
        open_ = (anchors.hi >= anchors.lo) & (most[:, None] >= needed) & (fewest[:, None] <= anchors.hi)
        which = np.flatnonzero(open_.any(1))
        if not len(which):
            return
        ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int32)
        score = _dot(anchors.vectors[which], _matrix(row["vectors"], self.dims))
        allowed = anchors.allowed(which, ids, labels, self.same)
        for j in range(anchors.lo.shape[1]):
            low = np.maximum(needed[which, j], anchors.lo[which, j])
            fits = allowed & (score >= low[:, None]) & (score <= anchors.hi[which, j, None])
            if fits.shape[1] > self.k:
                kth = np.partition(np.where(fits, score, _NONE), -self.k, axis=1)[:, -self.k]
                fits &= score >= kth[:, None]
            at, column = np.nonzero(fits)
            if not len(at):
                continue
            hit, slot = np.unique(at, return_inverse=True)
            have = self.score[which[hit], j] != _NONE
            old, place = np.nonzero(have)
            owner = np.concatenate((slot, old))
            s = np.concatenate((score[at, column], self.score[which[hit], j][old, place]))
            i = np.concatenate((ids[column], self.id[which[hit], j][old, place]))
            order = np.lexsort((i, -s, owner))
            owner, s, i = owner[order], s[order], i[order]
            rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
            first = rank < self.k
            for all_, new, empty in ((self.score, s, _NONE), (self.id, i, 0)):
                part = np.full((len(hit), self.k), empty)
                part[owner[first], rank[first]] = new[first]
                all_[which[hit], j] = part

    def found(self, q_block: int) -> pa.RecordBatch:
        row, target, place = np.nonzero(self.score != _NONE)
        columns = [np.full(len(row), q_block), row.astype(np.int32), target.astype(np.int32), self.anchors.ids[row], self.id[row, target, place], self.score[row, target, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["q_block", "row", "target", "anchor_id", "found_id", "score"])


def _scanned(space: Space, dims: int, k: int, same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, search = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                if key != (row["q_block"], row["slice"]):
                    if search is not None:
                        yield search.found(key[0])
                    key, search = (row["q_block"], row["slice"]), _Search(row, dims, space, k, same)
                search.see(row)
        if search is not None:
            yield search.found(key[0])

    return run


class Index:
    """Vectors stored by (pivot, distance), and exact searches in them."""

    def __init__(self, rows: DataFrame, dims: int, work: Workspace):
        """rows: (vec_id, label, vector array<int> of ``dims``); none may be null."""
        self.work, self.dims = work, dims
        some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
        self.ids, self.labels = some.column("vec_id").to_numpy(), some.column("label").to_numpy().astype(np.int32)
        self.vectors = some.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(len(self.ids), dims)
        norm = F.aggregate("vector", F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint") * x)
        self.space = Space(self.vectors, rows.agg(F.max(norm).alias("m")).first()["m"])
        self.rows = work.put(rows.mapInArrow(_keyed(self.space, dims), INDEXED), "keyed")
        self.blocks = self._stored(self.rows, BLOCK, "blocks")
        self.n_blocks = self.blocks.count()

    def _stored(self, rows: DataFrame, most: int, name: str) -> DataFrame:
        order = ("pivot", "distance", "vec_id")
        packed = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packed(most), BLOCKS)
        return self.work.put(packed.withColumn("block", F.monotonically_increasing_id()), name)

    def anchors(self, which) -> DataFrame:
        """Blocks of the rows that take part as anchors."""
        blocks = self._stored(self.rows.where(which), ANCHORS, "anchors")
        return blocks.select(F.col("block").alias("q_block"), F.col("n").alias("q_n"), *(F.col(c).alias(f"q_{c}") for c in ("ids", "labels", "vectors")))

    def search(self, anchors: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """(q_block, row, target, anchor_id, found_id, score, rank): for each target of each anchor, the first k rows of the same label, or of others, whose scores are from lo to hi."""
        space, dims = self.space, self.dims
        types = ", ".join(f"{c} {t}" for c, t in anchors.dtypes) + ", least binary"
        asked = self.work.put(anchors.mapInArrow(_bounded(space, dims, k, same, self.ids, self.labels, self.vectors), types), f"{name}-asked")
        wanted = asked.mapInArrow(_intervals(space, dims), "q_block bigint, pivot int, begin double, end double, near double, beyond double")
        salts, slices = max(1, self.n_blocks // SALTED), max(1, self.n_blocks // SLICE)
        spans = self.blocks.select("block", "pivot", "low", "high", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"))
        wanted = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        met = wanted.join(spans, ["pivot", "salt"]).where("low <= end and high >= begin")
        met = met.select("q_block", "block", F.greatest(F.col("low") - F.col("beyond"), F.col("near") - F.col("high"), F.lit(0.0)).alias("gap"), F.pmod(F.xxhash64("block", F.lit(1)), F.lit(slices)).alias("slice"))
        given = met.join(self.blocks, "block").join(asked, "q_block")
        given = given.select("q_block", "slice", "gap", "block", "pivot", "low", "high", "ids", "labels", "vectors", "q_ids", "q_labels", "q_vectors", "lo", "hi", "least")
        outwards = given.repartition("q_block", "slice").sortWithinPartitions("q_block", "slice", "gap", "block")
        found = self.work.put(outwards.mapInArrow(_scanned(space, dims, k, same), "q_block bigint, row int, target int, anchor_id bigint, found_id bigint, score bigint"), f"{name}-found")
        w = Window.partitionBy("q_block", "row", "target").orderBy(F.desc("score"), "found_id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _everything(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One target for each anchor: any score."""
    for batch in batches:
        n = batch.column("q_n").to_pylist()
        ends = [pa.array([np.full(x, v, np.int64).tobytes() for x in n], pa.binary()) for v in (_NONE, np.iinfo(np.int64).max)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *ends], names=[*batch.schema.names, "lo", "hi"])


def _hard(percent: tuple[int, int]):
    """A target for each positive: scores from 30 to 90 percent of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs = [], []
            for n, positives in zip(batch.column("q_n").to_pylist(), batch.column("positives").to_pylist()):
                lo, hi = np.ones((n, POSITIVES), np.int64), np.zeros((n, POSITIVES), np.int64)  # of a positive that is not there: none
                for p in positives:
                    at = p["row"], p["rank"] - 1
                    lo[at], hi[at] = -(-percent[0] * p["score"] // 100), percent[1] * p["score"] // 100
                lows.append(lo.tobytes())
                highs.append(hi.tobytes())
            keep = [c for c in batch.schema.names if c != "positives"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(lows, pa.binary()), pa.array(highs, pa.binary())], names=[*keep, "lo", "hi"])

    return run


def hard_negatives(embeddings: DataFrame, every: int = 100, percent: tuple[int, int] = (30, 90)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose vec_id is divisible by ``every``.  Scores are inner products of vectors whose components became
    floor(256 * x).  An anchor's positives are its first 5 rows of the same label; for each of them its first 10 rows of
    other labels with percent[0] * positive_score <= 100 * negative_score <= percent[1] * positive_score are returned, all if there are
    fewer.  Higher scores come first, ties by smaller vec_id.  Where vec_id is divisible by 7 the label first becomes (label + 1) % 10.

    Rows with a null vec_id, label, vector or component, or a component that is not finite, take no part; neither do rows with a component
    so large that scores would not fit in 64 bits (the square root of 10**17 by the number of components, after the scaling).  Shorter
    vectors are filled with zeros.  Equal rows count once, and no row with the anchor's id is its positive or negative; rows of one id
    with other vectors are searched like any other.  Other columns are ignored; an empty table gives an empty result.
    """
    work = Workspace(embeddings.sparkSession, "negatives")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where("vec_id is not null and label is not null and vector is not null")
    dims = rows.agg(F.max(F.size("vector")).alias("d")).first()["d"]
    shape = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if dims is None:
        return embeddings.sparkSession.createDataFrame([], shape)
    dims = max(1, dims)
    most = isqrt(LARGEST // dims)
    fits = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * 256 < most))
    scaled = F.transform("vector", lambda x: F.floor(x * 256).cast("int"))
    filled = F.slice(F.concat(scaled, F.array_repeat(F.lit(0), dims)), 1, dims)
    rows = work.put(rows.where(F.coalesce(fits, F.lit(False))).select("vec_id", "label", filled.alias("vector")).distinct(), "rows")
    if not rows.limit(1).count():
        return embeddings.sparkSession.createDataFrame([], shape)
    index = Index(rows, dims, work)
    anchors = index.anchors(F.col("vec_id") % every == 0)
    types = ", ".join(f"{c} {t}" for c, t in anchors.dtypes) + ", lo binary, hi binary"
    positives = work.put(index.search(anchors.mapInArrow(_everything, types), POSITIVES, True, "positives"), "positives")

    of_block = positives.groupBy("q_block").agg(F.collect_list(F.struct("row", "rank", "score")).alias("positives"))  # of ANCHORS rows at most
    hard = anchors.join(of_block, "q_block").mapInArrow(_hard(percent), types)
    found = index.search(hard, NEGATIVES, False, "negatives")
    named = positives.select("q_block", "row", (F.col("rank") - 1).alias("target"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(named, ["q_block", "row", "target"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


ORACLE = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM vectors a, vectors b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT * FROM (
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
    s.other_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
WHERE rank <= 10
"""
