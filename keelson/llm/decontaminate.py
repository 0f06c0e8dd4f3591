"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

An item of n words is found in a document if some run of its words is within
0.2 n word edits of it.  If so, some q words in a row of the item stand there
unchanged (q follows from n, no match is lost), and each such place proposes an item-sized
window of the document.  Windows and items are embedded by CGK random
walks: a walk stays on a word or goes on by a random bit that depends on the step and the
word, so a few edits shift it only until it meets the same words again, and edit
distance becomes Hamming distance.  Each walk is sampled at two random steps for every table; a window
that agrees with its item in any table of any walk is verified by its exact edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import U64, Texts, bounds_of, mix, pieces, ragged, range_hash, sequence_hash
from .workspace import Workspace, text_bytes

SIMILARITY = 0.8
#: 4 walks and 24 tables of 2 sampled steps each find 0.985 or more of windows at the largest distance (items of 5 to 120 words, 200
#: each, seed 1), and pass 0.95 (5 words), 0.63 (16), 0.16 (40) and 0.005 (120) of windows that share three words in a row only.
WALKS, TABLES, SAMPLES = 4, 24, 2
#: Items that a task holds at a time; a larger benchmark is matched block by block.
BLOCK_BYTES = 16 << 20
#: Proposals, and windows of them, that are looked at together; words after which a text that repeats itself is not looked at again.
PROPOSED, WINDOWS, PERIOD = 1 << 19, 4096, 8
HITS = "doc_id bigint, item_id bigint, distance int, item_words int, start_word bigint, end_word bigint"

#: A-Z lower-cased, ASCII punctuation a separator.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 32


def _words(texts: Texts):
    """Hashes of the plain words, their offsets by text."""
    joined, starts, ends, woff = Texts(_PLAIN[texts.buf], texts.off).joined()
    return range_hash(joined.buf, starts, ends), woff


def edits(n: int) -> int:
    """Word edits that an item of n words may have: distance / n is at most 0.2."""
    return n // 5


def steps(n):
    """Steps of a walk over n words that are sampled: it is seldom past the last word by then, and ends read differently."""
    return n * 8 // 5


class Items:
    """A block of benchmark items, with what a task needs to find them."""

    def __init__(self, ids: list[int], texts: list[str]):
        keep = list(pieces(pa.array(texts, pa.string()), 1 << 62))
        self.ids = np.array(ids, np.int64)
        self.word, self.off = _words(keep[0][2]) if keep else (np.zeros(0, U64), np.zeros(1, np.int64))
        self.n = np.diff(self.off)
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        longest = np.array([-(-(n - edits(n)) // (edits(n) + 1)) for n in self.n.tolist()], np.int64)
        for q in sorted(set(np.minimum(longest, 4).tolist()) - {0}):
            which = np.flatnonzero(np.minimum(longest, 4) == q)
            count = self.n[which] - q + 1
            at = np.repeat(self.off[which], count) + ragged(count)
            gram = sequence_hash(self.word, at, q)
            order = np.argsort(gram, kind="stable")
            self.grams[q] = (gram[order], np.repeat(which, count)[order], ragged(count)[order])
        rng = np.random.default_rng(7)
        self.salt = rng.integers(0, 2**64, (WALKS, steps(int(self.n.max(initial=0))) + 1), dtype=U64)
        self.steps = [rng.random((TABLES, SAMPLES)) for _ in range(WALKS)]
        every = np.arange(len(self.n))
        self.keys = self.embedded(self.word, self.off[:-1], self.off[1:], every, U64(0)) if len(every) else np.zeros((0, WALKS * TABLES), U64)

    def embedded(self, word: np.ndarray, start: np.ndarray, stop: np.ndarray, item: np.ndarray, end: U64) -> np.ndarray:
        """Table keys of the walks over words [start, stop), as long as those of the item; ``end`` is read behind the words."""
        length = steps(self.n[item])
        out = np.empty((len(start), WALKS * TABLES), U64)
        for w in range(WALKS):
            at = start.copy()
            picked = (self.steps[w][None] * length[:, None, None]).astype(np.int64)  # row, table, sample
            seen = np.zeros(picked.shape, U64)
            for j in range(int(length.max(initial=0))):
                here = np.where(at < stop, word[np.minimum(at, len(word) - 1)], end)
                r, t, s = np.nonzero(picked == j)
                seen[r, t, s] = here[r]
                at += (mix(here ^ self.salt[w, j]) & U64(1)).astype(np.int64)
            key = np.zeros(seen.shape[:2], U64)
            for s in range(SAMPLES):
                key = mix(key * U64(31) + seen[:, :, s])
            out[:, w * TABLES : (w + 1) * TABLES] = key
        return out

    def seeds(self, word: np.ndarray, woff: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, item, start) of windows proposed by words in a row that an item has too; some places of the texts at a time, in order, each time distinct."""
        of = np.repeat(np.arange(len(woff) - 1), np.diff(woff))
        # All windows that a word far inside a repetition proposes repeat earlier ones.
        span, every = int((self.n + self.n // 5).max(initial=0)), np.arange(len(word))
        first = ~_again(word, woff, of, every - span, every + span)
        asked = []
        for q, (gram, item, place) in self.grams.items():
            at = np.flatnonzero(first & (every + q <= woff[of + 1]))
            key = sequence_hash(word, at, q)
            maybe = np.zeros(1 << 20, bool)
            maybe[gram >> U64(44)] = True
            near = np.flatnonzero(maybe[key >> U64(44)])
            at, key = at[near], key[near]
            low, high = np.searchsorted(gram, key, "left"), np.searchsorted(gram, key, "right")
            asked.append((at, low, high - low, item, place))
        n = np.zeros(len(word) + 1, np.int64)
        for at, _, times, _, _ in asked:
            n[at + 1] += times
        total = np.cumsum(n)  # proposals of all words before a place
        begin = 0
        while begin < len(word) and total[-1] > total[begin]:
            end = max(begin + 1, int(np.searchsorted(total, total[begin] + PROPOSED, "right")) - 1)
            found = []
            for at, low, times, item, place in asked:
                some = slice(*np.searchsorted(at, (begin, end)))
                hit = np.repeat(low[some], times[some]) + ragged(times[some])
                here = np.repeat(at[some], times[some])
                found.append(np.stack([of[here], item[hit], here - place[hit]]))
            text, item, start = np.unique(np.concatenate(found, axis=1), axis=1)
            if len(text):
                yield text, item, start
            begin = end


def _again(word: np.ndarray, woff: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which runs [low, high) repeat, word for word, the run that begins up to PERIOD words before them in the same text."""
    out = np.zeros(len(low), bool)
    inside = (low >= woff[text]) & (high <= woff[text + 1])
    for p in range(1, PERIOD + 1):
        differs = np.zeros(len(word) + 1, np.int64)
        differs[p + 1 :] = word[p:] != word[:-p]
        differs = np.cumsum(differs)
        some = np.flatnonzero(inside & ~out & (low - p >= woff[text]))
        out[some] = differs[high[some]] == differs[low[some]]
    return out


def _distance(item: np.ndarray, segment: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to a run of the segment; the run's first start and end there."""
    m = len(segment)
    cost, origin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    ramp = np.arange(m + 1)
    for k, w in enumerate(item):
        step = np.empty(m + 1, np.int64)
        step[0] = k + 1
        from_ = np.zeros(m + 1, np.int64)
        diagonal, up = cost[:-1] + (segment != w), cost[1:] + 1
        step[1:] = np.minimum(diagonal, up)
        from_[1:] = np.where(diagonal <= up, origin[:-1], origin[1:])
        level = step - ramp
        best = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == best, ramp, 0))
        cost, origin = best + ramp, from_[source]
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


def _windows(items: Items, word: np.ndarray, woff: np.ndarray, best: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Proposed windows, some at a time, without those of items that were found unchanged by then and those that repeat an earlier one."""
    for text, item, start in items.seeds(word, woff):
        for s in range(0, len(text), WINDOWS):
            t, i, a = (x[s : s + WINDOWS] for x in (text, item, start))
            exact = np.array([t_ * len(items.n) + i_ for (t_, i_), x in best.items() if x[0] == 0], np.int64)
            reach = items.n[i] // 5
            keep = ~np.isin(t * len(items.n) + i, exact) & ~_again(word, woff, t, a - reach, a + items.n[i] + reach)
            if keep.any():
                yield t[keep], i[keep], a[keep]


def _longest(t, i, low, high, same, order) -> tuple[np.ndarray, ...]:
    """Of the segments of a text and item that are the same in one end, the first in an order."""
    at = np.lexsort((order, same, i, t))
    t, i, low, high, same = t[at], i[at], low[at], high[at], same[at]
    head = np.append(True, (t[1:] != t[:-1]) | (i[1:] != i[:-1]) | (same[1:] != same[:-1]))[: len(t)]
    return t[head], i[head], low[head], high[head]


def matches(items: Items, texts: Texts) -> list[tuple[int, int, int, int, int]]:
    """(text, item, distance, start, end in plain words), the best of each text and item."""
    word, woff = _words(texts)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for t, i, a in _windows(items, word, woff, best):
        low, high = np.maximum(a, woff[t]), np.minimum(a + items.n[i] + items.n[i] // 5, woff[t + 1])
        close = (items.embedded(word, low, high, i, U64(1)) == items.keys[i]).any(axis=1)
        t, i, a = t[close], i[close], a[close]
        reach = items.n[i] // 5
        low, high = np.maximum(a - reach, woff[t]), np.minimum(a + items.n[i] + reach, woff[t + 1])
        # Of segments that begin or end at the same place the longest holds what the others do.
        t, i, low, high = _longest(t, i, low, high, low, -high)
        t, i, low, high = _longest(t, i, low, high, high, low)
        order = np.lexsort((low, i, t))
        for tt, ii, first, last in zip(*(x[order].tolist() for x in (t, i, low, high))):
            if best.get((tt, ii), (1,))[0] == 0:
                continue
            d, b, e = _distance(items.word[items.off[ii] : items.off[ii + 1]], word[first:last])
            found = (d, first + b - int(woff[tt]), first + e - int(woff[tt]))
            if d <= int(items.n[ii]) // 5 and found < best.get((tt, ii), (1 << 60,)):
                best[tt, ii] = found
    return [(t, i, *x) for (t, i), x in sorted(best.items())]


def _matched(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in pieces(batch.column("text")):
                rows = matches(items, texts)
                if rows:
                    t, i, d, s, e = (np.array(x) for x in zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array(t + a)),
                            pa.array(items.ids[i]),
                            pa.array(d, pa.int32()),
                            pa.array(items.n[i], pa.int32()),
                            pa.array(s, pa.int64()),
                            pa.array(e, pa.int64()),
                        ],
                        names=[c.split()[0] for c in HITS.split(", ")],
                    )

    return run


def find_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item found in it: the least distance, and the words [start, end) of its first such place.

    Words are lower-cased (A-Z) and parted by white space and ASCII punctuation.  An item
    is found where its word edit distance to a run of the document is at most a fifth of its words;
    items of fewer than five words are found only unchanged.

    Long texts are taken whole, some places at a time; a stretch that repeats itself after at most eight words is compared once.
    Null texts and texts without words find nothing and are not found; items without an id are ignored, equal items
    are each reported.  Rows keep their doc_id, null or repeated; other columns are ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    Workspace(spark, "items")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    count = max(1, -(-text_bytes(items) // BLOCK_BYTES))
    out = None
    for k in range(count):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k).distinct().orderBy("item_id", "text").collect()
        held = Items([r["item_id"] for r in block], [r["text"] for r in block])
        part = docs.mapInArrow(_matched(held), HITS)
        out = part if out is None else out.unionByName(part)
    return out


def clean_of(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no item is found, with all their columns (rows without doc_id stay)."""
    found = find_items(docs, items).select(F.col("doc_id").alias("found_in")).distinct()
    return docs.join(found, docs["doc_id"].cast("bigint") == found["found_in"], "left_anti")
