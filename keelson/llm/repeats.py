"""Windows that repeat across documents: which of them also start in a document with a smaller id.

Three passes, each one Spark stage over all texts and one shuffle of packed keys:

1. ``Scheme.sample`` names some substrings of every text (a difference cover of
   the suffixes, or the symbols of a recompressed text).  Buckets of names are
   sorted one at a time; a name found in two documents is *tied*.  Every
   repeated window contains a tied name at a known place, so what is tied
   decides which windows can repeat at all.
2. ``Scheme.windows`` gives the windows that can repeat.  Their keys (64 bits, and those of
   the bucket from a second hash) are dealt to
   buckets and sorted one bucket at a time, in ``rounds`` rounds, each of which
   holds only its share of the keys on disk.  A bucket answers with one bit
   per key: does a smaller document have it?
3. The bits meet the texts again and each text is cut.

A block is the documents with one hash of their id and text (rows without an id, or of one id,
spread over blocks; equal ids never affect one another); a key goes out once per
block, with the block's smallest document, so a window that a third of all
documents share is a handful of entries in its bucket and not one per document.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import U64, Texts, bounds_of, pieces
from .workspace import Workspace, text_bytes

#: Rows without an id rank as if they had the largest one.
NO_ID = 2**63 - 1
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20

SAMPLED = "bucket int, tied boolean, blocks binary, counts binary, names binary"
TIED = "block int, bucket int, payload binary"
ENTRIES = "bucket int, block int, ids binary, counts binary, keys binary"


class Scheme(ABC):
    """What is sampled, and what a window is."""

    @abstractmethod
    def prepare(self, texts: Texts):
        """What the other methods need of some texts, worked out once."""

    @abstractmethod
    def sample(self, work) -> tuple[np.ndarray, np.ndarray]:
        """(names, index of the text of each)."""

    @abstractmethod
    def windows(self, work, is_tied) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(key, a second key, start, index of the text) of each window that can repeat, in order of position."""

    @abstractmethod
    def finish(self, work, starts: np.ndarray, ids: np.ndarray) -> pa.Table:
        """Result rows for all texts, given the starts of the windows found in smaller documents."""


def _bucket(names: np.ndarray, bits: int) -> np.ndarray:
    return (names >> U64(64 - bits)).astype(np.int64)


def _remainder(names: np.ndarray, bits: int) -> np.ndarray:
    """32 bits below the bucket's: a name only rules windows out, so two that are taken for equal cost work but change nothing."""
    return (names << U64(bits) >> U64(32)).astype(np.uint32)


def _mapped(scheme: Scheme, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy(zero_copy_only=False)
            for a, b, texts in pieces(batch.column("text")):
                names, of = scheme.sample(scheme.prepare(texts))
                yield from _packed(names, of, block[a:b], bits)

    return run


def _packed(names, of, block, bits) -> Iterator[pa.RecordBatch]:
    order = np.argsort(names)
    names, of = names[order], of[order]
    fresh = np.ones(len(names), bool)
    fresh[1:] = (names[1:] != names[:-1]) | (of[1:] != of[:-1])
    names, at = names[fresh], block[of[fresh]]
    first = np.ones(len(names), bool)
    first[1:] = names[1:] != names[:-1]
    many = ~(first & np.append(first[1:], True))  # names of two documents of this piece: tied already
    rows: dict[str, list] = {k: [] for k in ("bucket", "tied", "blocks", "counts", "names")}
    for tied, keep in ((False, first), (True, many)):
        n, at_ = names[keep], at[keep]
        bucket = _bucket(n, bits)
        order = np.lexsort((at_, bucket))
        n, at_, bucket = n[order], at_[order], bucket[order]
        short = _remainder(n, bits)
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(n) else np.zeros(0, np.int64)
        for s, e in zip(cuts, [*cuts[1:], len(n)]):
            runs = np.flatnonzero(np.append(True, at_[s + 1 : e] != at_[s : e - 1]))
            rows["bucket"].append(int(bucket[s]))
            rows["tied"].append(tied)
            rows["blocks"].append(at_[s:e][runs].astype(np.int32).tobytes())
            rows["counts"].append(np.diff(np.append(runs, e - s)).astype(np.int32).tobytes())
            rows["names"].append(short[s:e].tobytes())
    if rows["bucket"]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["bucket"], pa.int32()), pa.array(rows["tied"], pa.bool_()), *(pa.array(rows[k], pa.binary()) for k in ("blocks", "counts", "names"))],
            names=list(rows),
        )


def _joined(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), dtype)


def _ties(group: pa.Table) -> pa.Table:
    flags = group.column("tied").to_numpy(zero_copy_only=False).astype(bool)
    bucket = group.column("bucket")[0].as_py()
    found = []
    for tied in (True, False):
        part = group.filter(pa.array(flags == tied))
        names = _joined(part.column("names"), np.uint32)
        at = np.repeat(_joined(part.column("blocks"), np.int32), _joined(part.column("counts"), np.int32))
        if not tied and len(names):
            order = np.argsort(names)
            names, at = names[order], at[order]
            same = names[1:] == names[:-1]
            keep = np.append(same, False) | np.append(False, same)
            names, at = names[keep], at[keep]
        found.append((names, at))
    names, at = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((names, at))
    names, at = names[order], at[order]
    fresh = np.ones(len(names), bool)
    fresh[1:] = (names[1:] != names[:-1]) | (at[1:] != at[:-1])
    names, at = names[fresh], at[fresh]
    cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(at))
    return pa.table(
        {
            "block": pa.array(at[cuts], pa.int32()),
            "bucket": pa.array(np.full(len(cuts), bucket), pa.int32()),
            "payload": pa.array([names[s:e].tobytes() for s, e in zip(cuts, ends)], pa.binary()),
        }
    )


def _tied_test(replies: pa.Table, bits: int):
    """A function that tells which names are tied, from a block's replies."""
    full = []
    for bucket, payload in zip(replies.column("bucket").to_pylist(), replies.column("payload")):
        low = np.frombuffer(payload.as_py(), np.uint32).astype(U64)
        full.append((U64(bucket) << U64(64 - bits)) | (low << U64(32 - bits)))
    known = np.sort(np.concatenate(full)) if full else np.zeros(0, U64)
    mask = U64((2**64 - 1) ^ (2 ** (32 - bits) - 1))
    maybe = np.zeros(1 << 22, bool)  # by the leading bits: most names that are not tied need no search
    maybe[known >> U64(42)] = True

    def test(names: np.ndarray) -> np.ndarray:
        found = maybe[names >> U64(42)]
        at = np.flatnonzero(found)
        sought = names[at] & mask
        found[at] = known[np.minimum(np.searchsorted(known, sought), len(known) - 1)] == sought if len(at) else False
        return found

    return test


def _block(docs: pa.Table) -> tuple[np.ndarray, np.ndarray, Texts]:
    """Ids, whether they are known, and texts of a block, by id."""
    docs = docs.sort_by("doc_id")
    parts = list(pieces(docs.column("text"), 1 << 62))
    return docs.column("doc_id").to_numpy(), docs.column("known").to_numpy(), parts[0][2] if parts else Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))


def _keys(scheme: Scheme, work, replies: pa.Table, bits: int, only: tuple[int, int] | None = None):
    """Windows of a block, and its distinct keys by (bucket, first text, key); of some buckets only, or of all.

    The bucket comes from the second key, so that windows are told apart by 64 bits and those of the bucket.
    -> starts, text of each window, index of each window's key, distinct keys, their first text, their buckets
    """
    keys, second, starts, of = scheme.windows(work, _tied_test(replies, bits))
    buckets = _bucket(second, bits)
    if only:
        keep = (buckets >= only[0]) & (buckets < only[1])
        keys, buckets, starts, of = keys[keep], buckets[keep], starts[keep], of[keep]
    order = np.argsort(keys)
    head = np.ones(len(keys), bool)
    head[1:] = (keys[order][1:] != keys[order][:-1]) | (buckets[order][1:] != buckets[order][:-1])
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(head) - 1
    distinct, bucket = keys[order][head], buckets[order][head]
    first = np.minimum.reduceat(of[order], np.flatnonzero(head)) if len(keys) else of  # texts are in order of id
    rank = np.argsort(bucket << 40 | first, kind="stable")  # keys are in order already
    back = np.empty(len(rank), np.int64)
    back[rank] = np.arange(len(rank))
    return starts, of, back[which] if len(which) else which, distinct[rank], first[rank], bucket[rank]


def _sent(scheme: Scheme, bits: int, low: int, high: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        ids, _, texts = _block(docs)
        rows: dict[str, list] = {k: [] for k in ("bucket", "block", "ids", "counts", "keys")}
        if len(ids) and replies.num_rows:
            block = docs.column("block")[0].as_py()
            *_, keys, first, bucket = _keys(scheme, scheme.prepare(texts), replies, bits, (low, high))
            cuts = np.searchsorted(bucket, np.arange(low, high + 1))
            for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])):
                if e > s:
                    runs = np.flatnonzero(np.append(True, first[s + 1 : e] != first[s : e - 1]))
                    rows["bucket"].append(low + k)
                    rows["block"].append(block)
                    rows["ids"].append(ids[first[s:e][runs]].astype(np.int64).tobytes())
                    rows["counts"].append(np.diff(np.append(runs, e - s)).astype(np.int32).tobytes())
                    rows["keys"].append(keys[s:e].tobytes())
        return pa.table(
            {"bucket": pa.array(rows["bucket"], pa.int32()), "block": pa.array(rows["block"], pa.int32())}
            | {k: pa.array(rows[k], pa.binary()) for k in ("ids", "counts", "keys")}
        )

    return run


def _answer(group: pa.Table) -> pa.Table:
    """One bucket, sorted: which block's smallest document is not the smallest of all that have the key."""
    keys = _joined(group.column("keys"), np.uint64)
    ids = np.repeat(_joined(group.column("ids"), np.int64), _joined(group.column("counts"), np.int32))
    order = np.argsort(keys)
    head = np.ones(len(keys), bool)
    head[1:] = keys[order][1:] != keys[order][:-1]
    least = np.minimum.reduceat(ids[order], np.flatnonzero(head)) if len(keys) else ids
    later = np.empty(len(keys), bool)
    later[order] = ids[order] > least[np.cumsum(head) - 1]
    sizes = np.array([len(x.as_py()) // 8 for x in group.column("keys")], np.int64)
    at = bounds_of(sizes)
    return pa.table(
        {
            "block": group.column("block"),
            "bucket": group.column("bucket"),
            "payload": pa.array([np.packbits(later[s:e]).tobytes() for s, e in zip(at[:-1], at[1:])], pa.binary()),
        }
    )


def _cut(scheme: Scheme, bits: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        ids, known, texts = _block(docs)
        work = scheme.prepare(texts)
        kinds = replies.column("kind").to_numpy(zero_copy_only=False)
        tied, answers = (replies.filter(pa.array(kinds == k)) for k in (0, 1))
        found = np.zeros(0, np.int64)
        if tied.num_rows:
            starts, of, which, keys, first, bucket = _keys(scheme, work, tied, bits)
            later = np.zeros(len(keys), bool)
            for b, payload in zip(answers.column("bucket").to_pylist(), answers.column("payload")):
                s, e = np.searchsorted(bucket, (b, b + 1))
                later[s:e] = np.unpackbits(np.frombuffer(payload.as_py(), np.uint8), count=e - s).astype(bool)
            found = starts[later[which] | (ids[of] > ids[first[which]])]
        out = scheme.finish(work, found, ids)
        return out.set_column(0, "doc_id", pa.array(ids, pa.int64(), mask=~known))

    return run


def repeated(docs: DataFrame, scheme: Scheme, result: str, label: str, rounds: int = 1) -> DataFrame:
    """``scheme``'s result for every document of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    work = Workspace(spark, label)
    size = text_bytes(docs)
    blocks = max(1, -(-size // BLOCK_BYTES))
    bits = max(6, (size // BUCKET_BYTES).bit_length())
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("known"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    sampled = docs.select("block", "text").mapInArrow(_mapped(scheme, bits), SAMPLED)
    tied = work.put(sampled.groupBy("bucket").applyInArrow(_ties, TIED), "tied")

    by_block = docs.groupBy("block")
    answers = None
    edges = np.linspace(0, 1 << bits, rounds + 1).astype(int)
    for k, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
        sent = by_block.cogroup(tied.groupBy("block")).applyInArrow(_sent(scheme, bits, int(low), int(high)), ENTRIES)
        part = work.put(sent.groupBy("bucket").applyInArrow(_answer, TIED), f"answers{k}")
        answers = part if answers is None else answers.unionByName(part)

    replies = tied.withColumn("kind", F.lit(0)).unionByName(answers.withColumn("kind", F.lit(1)))
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(_cut(scheme, bits), result)
