"""SimHash near-dedup with an index of fingerprint bytes by position.

Fingerprints at most three bits apart differ in at most three of their eight
bytes, so they share at least five bytes in place.  A posting list for each single
byte would hold a 256th of all fingerprints and its pairs would grow with their
square.  The lists are therefore kept for sets of four positions: the fourteen
blocks of the Steiner system S(3, 4, 8) are such that whichever three
positions differ, one block avoids them.  Within a list each of the four other positions has
posting lists of its bytes; a pair's meetings there are tallied with the list's four bytes, pairs that reach
the guaranteed five are retained and their bits compared.
A list of more than ``LIST`` different fingerprints is dealt again, by the
four fixed bytes and five of the eight other half bytes, at least five of which a linked
pair shares: at most 4096 different fingerprints are left to a list then, whatever the data.
A list hands on a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .textbatch import U64, pieces, xxh64
from .workspace import Workspace

DISTANCE, SHARED, SHINGLE, SEED, LIST = 3, 5, 3, 42, 1024

#: The blocks of S(3, 4, 8) over the byte positions.
BLOCKS = (
    (0, 1, 2, 3), (4, 5, 6, 7), (0, 1, 4, 5), (2, 3, 6, 7), (0, 1, 6, 7), (2, 3, 4, 5), (0, 2, 4, 6),
    (1, 3, 5, 7), (0, 2, 5, 7), (1, 3, 4, 6), (0, 3, 4, 7), (1, 2, 5, 6), (0, 3, 5, 6), (1, 2, 4, 7),
)

#: The byte positions that a list does not fix.
_FREE = np.array([[p for p in range(8) if p not in b] for b in BLOCKS])

LINKS = "a bigint, b bigint, block int, fingerprint bigint"


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _mask(units, width: int) -> int:
    return sum(((1 << width) - 1) << (width * u) for u in units)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.zeros(batch.num_rows, U64)
        for a, b, texts in pieces(batch.column("text")):
            out[a:b] = fingerprints(texts)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out.view(np.int64))], names=["doc_id", "fingerprint"])


def fingerprints(texts) -> np.ndarray:
    """SimHash of each text: bits set in over half of the hashes of its word shingles."""
    joined, starts, ends, woff = texts.lower().joined()
    words = np.diff(woff)
    count = np.where(words > 0, np.maximum(words - SHINGLE + 1, 1), 0)
    first = np.repeat(woff[:-1], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    last = first + np.repeat(np.minimum(np.maximum(words, 1), SHINGLE) - 1, count)
    h = xxh64(joined.buf, starts[first], ends[last] - starts[first], SEED)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros(len(words), U64)
    some = np.flatnonzero(count)
    if len(some):
        votes = np.add.reduceat(bits, (np.cumsum(count) - count)[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(votes * 2 > count[some, None], axis=1, bitorder="little").view(U64).ravel()
    return out


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each of n nodes is connected with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            return root


def _near(fp: np.ndarray, block: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (indices) of linked fingerprints of the same list.

    Rows of a list meet again under each byte that they share at one of the positions that the list leaves free.  The
    tally of these meetings and the list's own bytes is what a pair shares; pairs that reach the guaranteed number are verified.
    """
    position = _FREE[block]
    byte = (fp[:, None] >> (position.astype(U64) << U64(3))) & U64(255)
    posting = (number[:, None] << 11 | position << 8 | byte.astype(np.int64)).ravel()
    order = np.argsort(posting, kind="stable")
    posting, row = posting[order], order // _FREE.shape[1]
    cuts = np.flatnonzero(np.append(True, posting[1:] != posting[:-1])) if len(posting) else np.zeros(0, np.int64)
    size = np.diff(np.append(cuts, len(posting)))
    end, at, met, lag = np.repeat(cuts + size, size), np.arange(len(posting)), [np.zeros(0, np.int64)], 1
    at = at[end - at > 1]
    while len(at):
        met.append(row[at] << 32 | row[at + lag])
        lag += 1
        at = at[end[at] - at > lag]
    pair, tally = np.unique(np.concatenate(met), return_counts=True)
    pair = pair[tally + len(BLOCKS[0]) >= SHARED]
    a, b = pair >> 32, pair & 0xFFFFFFFF
    linked = np.bitwise_count(fp[a] ^ fp[b]) <= DISTANCE
    return a[linked], b[linked]


def _lists(limit: int | None):
    """Links within posting lists of rows sorted by key; lists beyond the limit are handed on as they are."""

    def close(key, fp, doc, block) -> pa.RecordBatch:
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
        key, fp, doc, block = key[fresh], fp[fresh], doc[fresh], block[fresh]
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(head, len(key)))
        over = np.repeat(size > limit, size) if limit else np.zeros(len(key), bool)
        root, held = np.arange(len(key)), []
        rows, number = np.flatnonzero(~over & np.repeat(size > 1, size)), np.repeat(np.arange(len(head)), size)
        work = np.cumsum(np.repeat(size, size)[rows]) >> 21  # so many comparisons at most, or one list, at a time
        for part in np.split(rows, np.flatnonzero(np.diff(work[np.searchsorted(number[rows], number[rows])])) + 1 if len(rows) else []):
            x, y = _near(fp[part], block[part], number[part])
            held.append((part[x], part[y]))
            if sum(len(x) for x, _ in held) > 1 << 20:
                a, b = (np.concatenate(x) for x in zip(*held))
                root, held = _forest(len(key), np.append(a, np.arange(len(key))), np.append(b, root)), []
        if held:
            a, b = (np.concatenate(x) for x in zip(*held))
            root = _forest(len(key), np.append(a, np.arange(len(key))), np.append(b, root))
        tied = np.flatnonzero(root != np.arange(len(key)))
        on = np.flatnonzero(over)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(doc[tied], doc[on]), pa.int64()),
                pa.array(np.append(doc[root[tied]], doc[on]), pa.int64()),
                pa.array(np.append(np.full(len(tied), -1), block[on]), pa.int32()),
                pa.array(np.append(np.zeros(len(tied), np.int64), fp[on].view(np.int64)), pa.int64()),
            ],
            names=["a", "b", "block", "fingerprint"],
        )

    def handed_on(fp, doc, block) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(doc, pa.int64()), pa.array(block, pa.int32()), pa.array(fp.view(np.int64))],
            names=["a", "b", "block", "fingerprint"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, long = None, None
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("key", "fingerprint", "doc_id", "block")]
            cols[1] = cols[1].view(U64)
            if long is not None:  # more of a list that was too long to hold
                more = int(np.searchsorted(cols[0], long, "right"))
                yield handed_on(*(x[:more] for x in cols[1:]))
                cols = [x[more:] for x in cols]
            held = cols if held is None else [np.append(a, b) for a, b in zip(held, cols)]
            if len(held[0]) <= 1 << 17:
                continue
            cut = int(np.searchsorted(held[0], held[0][-1], "left"))
            if cut:
                yield close(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
            elif limit:
                long = held[0][-1]
                yield handed_on(*held[1:])
                held = [x[:0] for x in held]
        if held is not None and len(held[0]):
            yield close(*held)

    return run


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprint (hex) and component_id, the smallest doc_id reachable by links.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; shingles are three
    words, repeats included; a shorter text is one shingle, and a text without words
    (or null) has fingerprint zero, which links like any other.  Fingerprints link at
    three or fewer differing bits.  Rows without doc_id are returned with a null
    component_id.  Rows that share a doc_id keep a row each.  Other columns are
    ignored; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession, "simhash")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = work.put(docs.mapInArrow(_fingerprints, "doc_id bigint, fingerprint bigint"), "fingerprints")
    classes = found.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))

    postings = classes.select(
        "fingerprint",
        "doc_id",
        F.posexplode(F.array(*(F.col("fingerprint").bitwiseAND(_signed(_mask(b, 8))) for b in BLOCKS))).alias("block", "part"),
    ).select(F.xxhash64("block", "part").alias("key"), "fingerprint", "doc_id", "block")
    first = work.put(_in_lists(postings, LIST), "lists")

    free = []
    for b in BLOCKS:
        other = [p for p in range(8) if p not in b]
        halves = [2 * p + k for p in other for k in (0, 1)]
        free.append(F.array(*(F.lit(_signed(_mask(b, 8) | _mask(c, 4))) for c in combinations(halves, SHARED))))
    hot = first.where("block >= 0").select(F.col("a").alias("doc_id"), "fingerprint", "block")
    again = hot.select("fingerprint", "doc_id", "block", F.posexplode(F.element_at(F.array(*free), F.col("block") + 1)).alias("k", "mask")).select(
        F.xxhash64("block", "k", F.col("fingerprint").bitwiseAND(F.col("mask"))).alias("key"), "fingerprint", "doc_id", "block"
    )
    links = first.where("block < 0").unionByName(_in_lists(again, None)).select("a", "b")
    found_in = components(links, work).withColumnsRenamed({"node": "doc_id", "component": "component_id"})

    labels = classes.join(found_in, "doc_id", "left").select("fingerprint", F.coalesce("component_id", "doc_id").alias("component_id"))
    labels = work.put(labels, "labels")
    return found.join(labels, "fingerprint", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def _in_lists(postings: DataFrame, limit: int | None) -> DataFrame:
    return postings.repartition("key").sortWithinPartitions("key", "fingerprint").mapInArrow(_lists(limit), LINKS)
