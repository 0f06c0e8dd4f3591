"""Substring dedup over words by recompression.

Every text is a sequence of word symbols.  A round names maximal runs of one
symbol, then pairs: each symbol falls on the left or right side by one bit of
its name, and a left symbol followed by a right one becomes a new symbol.  A name is a
64-bit function of the names below it, so all tasks agree on it without
exchanging a dictionary, and equal substrings get equal symbols except near
their ends.  For each symbol the words that decided about it (its context) are known;
a symbol whose context lies inside a repeated window stands in both
occurrences.  So one Spark pass finds the symbols that two documents share, a window
with any symbol of its own that no other document has is ruled out, and the remaining
windows are verified by a key of all their words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import Scheme, repeated
from .textbatch import U64, Texts, bounds_of, mix, range_hash, sequence_hash

RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
_RUN, _PAIR, _SIDE = U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB)
_FAR = 1 << 60


class Symbols:
    """One level: name, words [start, end), context [left, right), text of each symbol."""

    def __init__(self, name, start, end, left, right, of):
        self.name, self.start, self.end, self.left, self.right, self.of = name, start, end, left, right, of

    @classmethod
    def words(cls, name: np.ndarray, of: np.ndarray) -> Symbols:
        at = np.arange(len(name), dtype=np.int64)
        return cls(name, at, at + 1, at, at + 1, of)

    def _beside(self) -> tuple[np.ndarray, np.ndarray]:
        """Contexts of the neighbours in the same text: left ends of the left one, right ends of the right one."""
        inner = self.of[1:] == self.of[:-1]
        left, right = np.full(len(self.of), -_FAR), np.full(len(self.of), _FAR)
        left[1:][inner] = self.left[:-1][inner]
        right[:-1][inner] = self.right[1:][inner]
        return left, right

    def _merged(self, head: np.ndarray, name: np.ndarray, left: np.ndarray, right: np.ndarray) -> Symbols:
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(head)) - 1
        return Symbols(name, self.start[first], self.end[last], np.minimum(left[first], left[last]), np.maximum(right[first], right[last]), self.of[first])

    def runs(self) -> Symbols:
        head = np.ones(len(self.of), bool)
        head[1:] = (self.of[1:] != self.of[:-1]) | (self.name[1:] != self.name[:-1])
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, len(head))).astype(U64)
        name = self.name[first]
        name = np.where(size > 1, mix(name ^ (size * _RUN)), name)
        left, right = self._beside()
        return self._merged(head, name, np.minimum(left, self.left), np.maximum(right, self.right))

    def pairs(self, level: int) -> Symbols:
        n = len(self.of)
        is_left = (mix(self.name + U64(level * int(_SIDE) % 2**64)) & U64(1)).astype(bool)
        joins = np.zeros(n, bool)  # with the next one
        joins[:-1] = is_left[:-1] & ~is_left[1:] & (self.of[1:] == self.of[:-1])
        joined = np.append(False, joins[:-1])
        beside_left, beside_right = self._beside()
        alone = ~(joins | joined)
        left = np.where(alone & ~is_left, np.minimum(beside_left, self.left), self.left)
        right = np.where(alone & is_left, np.maximum(beside_right, self.right), self.right)
        head = ~joined
        first = np.flatnonzero(head)
        name = self.name[first]
        two = joins[first]
        name[two] = mix(mix(name[two] ^ _PAIR) * U64(3) + self.name[first[two] + 1])
        return self._merged(head, name, left, right)


class WordWindows(Scheme):
    def __init__(self, words: int, levels: int):
        self.words, self.levels = words, levels

    def prepare(self, texts: Texts):
        joined, starts, ends, woff = texts.joined()
        return joined, (range_hash(joined.buf, starts, ends), range_hash(joined.buf, starts, ends, 1)), starts, ends, woff

    def _symbols(self, work) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(name, left, right, text) of the symbols of several words that a window can decide."""
        _, words, _, _, woff = work
        of = np.repeat(np.arange(len(woff) - 1), np.diff(woff))
        level, found = Symbols.words(words[0], of), [(np.zeros(0, U64), *(np.zeros(0, np.int64),) * 3)]
        for k in range(1, self.levels + 1) if len(of) else ():
            level = level.runs().pairs(k)
            if k > 1:
                keep = (level.end - level.start > 1) & (level.right - level.left <= self.words)
                found.append((level.name[keep], level.left[keep], level.right[keep], level.of[keep]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def sample(self, work):
        name, _, _, of = self._symbols(work)
        return name, of

    def windows(self, work, is_tied):
        _, words, starts, _, woff = work
        name, left, right, _ = self._symbols(work)
        own = ~is_tied(name)
        change = np.zeros(len(starts) + 2, np.int32)
        np.add.at(change, np.maximum(right[own] - self.words, 0), 1)
        np.add.at(change, left[own] + 1, -1)
        fits = np.zeros(len(starts) + 1, np.int32)
        count = np.diff(woff)
        long = count >= self.words
        np.add.at(fits, woff[:-1][long], 1)
        np.add.at(fits, woff[1:][long] - self.words + 1, -1)
        at = np.flatnonzero((np.cumsum(change[: len(starts)], dtype=np.int32) == 0) & (np.cumsum(fits[:-1], dtype=np.int32) > 0))
        return *(sequence_hash(x, at, self.words) for x in words), at, np.searchsorted(woff, at, "right") - 1

    def finish(self, work, starts, ids):
        joined, _, begin, end, woff = work
        change = np.zeros(len(begin) + 1, np.int32)
        change[starts] += 1
        change[starts + self.words] -= 1
        keep = np.cumsum(change[:-1], dtype=np.int32) <= 0
        size = end - begin + 1
        kept = joined.buf[np.repeat(keep, size)].tobytes()
        at = bounds_of(np.where(keep, size, 0))[woff]
        n = np.diff(woff)
        left = np.diff(bounds_of(keep)[woff])
        texts = [kept[s : max(s, e - 1)] for s, e in zip(at[:-1], at[1:])]
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(n, pa.int64()),
                "n_removed": pa.array(n - left, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
            }
        )


def dedup_word_windows(docs: DataFrame, words: int = 13, levels: int = 3, rounds: int = 1) -> DataFrame:
    """One row per document: what is left once repeated windows of ``words`` words are removed.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word goes if a window that
    covers it has a word sequence that also starts in a document with a smaller
    doc_id; windows stay inside a document and are judged on the input.

    Null texts have no words; neither have empty ones.  Rows without doc_id rank
    as if they had the largest one, 2**63 - 1; rows that share a doc_id do not
    affect one another.  Other columns are ignored; an empty table gives an empty result.
    """
    return repeated(docs, WordWindows(words, levels), RESULT, "windows", rounds)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
pos AS (SELECT doc_id, p, words[p] AS word FROM w, unnest(range(1, len(words) + 1)) AS u(p)),
win AS (SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS k FROM w, unnest(range(1, len(words) - 11)) AS u(p)),
least_id AS (SELECT k, min(doc_id) AS d FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, p + j AS p FROM win JOIN least_id USING (k), unnest(range(0, 13)) AS v(j) WHERE doc_id > d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
