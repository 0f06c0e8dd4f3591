"""Suffix-array dedup: bytes covered by a string that an earlier document has too.

The suffixes are built blockwise, with a difference cover.  Of every 31 suffixes
of a text the six at the positions of a perfect difference set are sampled: for any two
suffixes there is a shift below 31 that takes both to sampled ones.  Sampled suffixes are ranked
first (by their leading bytes, equal or not); then one bucket of the suffixes at a time is
sorted to the match length, and only those suffixes enter that have a tied
sampled suffix within the next 31 positions, as two long-tied suffixes must.
Memory is bounded by a bucket and disk by the buckets of a round.

Equality to the match length is all that dedup needs, so within a bucket
suffixes are ordered by a 64-bit key of their leading bytes (with the bucket and the block's
first document, not by collation): equal strings meet, which is what ranks are used for.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import Scheme, repeated
from .textbatch import Texts, bounds_of, ragged, window_hash

#: A perfect difference set: every residue modulo PERIOD is a difference of two members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"


class ByteStrings(Scheme):
    def __init__(self, length: int):
        if length <= PERIOD:
            raise ValueError(f"length must exceed {PERIOD}")
        self.length, self.depth = length, length - PERIOD + 1

    def prepare(self, texts: Texts):
        return texts

    def _sampled(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lens = np.diff(texts.off)
        longest = int(lens.max()) if len(lens) else 0
        places = (np.arange(0, longest + PERIOD, PERIOD)[:, None] + np.array(COVER)).ravel()
        count = np.where(lens >= self.length, np.searchsorted(places, lens - self.depth, "right"), 0)
        at = places[ragged(count)] + np.repeat(texts.off[:-1], count)
        return window_hash(texts.buf, at, self.depth)[0], at, np.repeat(np.arange(len(lens)), count)

    def sample(self, work):
        names, _, of = self._sampled(work)
        return names, of

    def windows(self, work, is_tied):
        texts = work
        names, at, of = self._sampled(texts)
        keep = is_tied(names)
        at, of = at[keep], of[keep]
        low = np.maximum(at - PERIOD + 1, texts.off[of])
        high = np.minimum(at, texts.off[of + 1] - self.length)
        keep = high >= low
        change = np.zeros(len(texts.buf) + 2, np.int32)
        np.add.at(change, low[keep], 1)
        np.add.at(change, high[keep] + 1, -1)
        starts = np.flatnonzero(np.cumsum(change[:-1], dtype=np.int32))
        per = np.diff(np.searchsorted(starts, texts.off))
        return *window_hash(texts.buf, starts, self.length), starts, np.repeat(np.arange(len(per)), per)

    def finish(self, work, starts, ids):
        texts = work
        change = np.zeros(len(texts.buf) + 1, np.int32)
        change[starts] += 1
        change[starts + self.length] -= 1  # starts are distinct
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        edge = np.zeros(len(gone) + 1, bool)
        edge[1:-1] = gone[1:] != gone[:-1]
        edge[texts.off] = True
        opens = np.flatnonzero(edge[:-1] & gone)
        closes = np.flatnonzero(edge[1:] & gone) + 1
        per = np.diff(np.searchsorted(opens, texts.off))
        kept = texts.buf[~gone].tobytes()
        total = bounds_of(~gone)
        at = total[texts.off]
        base = np.repeat(texts.off[:-1], per)
        spans = pa.ListArray.from_arrays(
            pa.array(bounds_of(per), pa.int32()),
            pa.StructArray.from_arrays([pa.array(opens - base, pa.int64()), pa.array(closes - base, pa.int64())], names=["start", "end"]),
        )
        lens = np.diff(texts.off)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_bytes": pa.array(lens, pa.int64()),
                "n_removed": pa.array(lens - np.diff(at), pa.int64()),
                "n_spans": pa.array(per, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(kept[s:e]).hexdigest() for s, e in zip(at[:-1], at[1:])], pa.string()),
                "spans": spans,
            }
        )


def dedup_substrings(docs: DataFrame, length: int = 50, rounds: int = 2) -> DataFrame:
    """One row per document: what is left once repeated ``length``-byte strings are removed.

    A byte goes if a string of ``length`` bytes that covers it also starts in a
    document with a smaller doc_id.  Matches stay inside a document and are judged
    on the input.  ``spans`` lists the maximal removed runs (byte offsets).

    Null texts are empty texts.  Rows without doc_id rank as if
    they had the largest one, 2**63 - 1.  Rows that share a doc_id do not affect one another.
    Texts shorter than ``length`` keep every byte.  Other columns are ignored;
    an empty table gives an empty result.
    """
    return repeated(docs, ByteStrings(length), RESULT, "substrings", rounds)
