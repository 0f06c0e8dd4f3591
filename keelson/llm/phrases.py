"""Phrase collocation mining by growing contiguous patterns from frequent prefixes.

A first pass counts words; only frequent ones are grown.  Which those are, a second pass sees in a bitmap of fixed
size, in which a rare word may be taken for a frequent one but not the reverse.  It projects: each occurrence of a word
becomes a pointer that carries the words behind it in its piece.  Tasks put the occurrences they see in order, so equal pointers travel once with their
number, and deal them by the prefix and its next word: no prefix, however common, is one
task's.  The task that holds a prefix grows it to the right, depth first: it counts what
follows, keeps the extensions that are frequent, and grows each of them on the pointers that are left.

Words travel as 64-bit names.  That no two words of the table share a name is checked on all of
them, else others are dealt; so counts are exact.  Scores are worked out in decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textbatch import U64, Texts, bounds_of, mix, pieces, range_hash
from .workspace import Workspace, text_bytes

LEAST, LONGEST, REPORT = 10, 3, 2000
#: A phrase is dropped if a longer one that holds it has half of its occurrences.
ABSORBED = 50
#: Bytes of text a bucket of prefixes stands for, and occurrences that a task puts in order at a time.
BUCKET_BYTES, OCCURRENCES = 4 << 20, 1_000_000
#: Bits of the map of frequent words, by name: 4 MB however many words there are.
FREQUENT_BITS = 1 << 25
PREFIXES = 64
WORDS = "name bigint, lang string, word string, n bigint"
PACKED = "bucket bigint, names binary, wide boolean, codes binary"
GROWN = "w bigint, x bigint, y bigint, a bigint"

_BREAK, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP[[0x20, 0x09]] = True
_STEP = U64(0x9E3779B97F4A7C15)


class Words:
    """The words of some texts: where they stand, and how many words of its piece come behind each (LONGEST - 1 at most)."""

    def __init__(self, texts: Texts):
        self.texts = low = texts.lower()
        buf, off = low.buf, low.off
        word = ~(_BREAK | _GAP)[buf]
        edge = np.zeros(len(word) + 1, bool)
        edge[1:-1] = word[1:] != word[:-1]
        edge[off[:-1][off[:-1] < len(word)]] = True
        edge[[0, -1]] = True
        cut = np.flatnonzero(edge)
        inside = word[cut[:-1]] if len(word) else np.zeros(0, bool)
        self.start, self.end = cut[:-1][inside], cut[1:][inside]
        self.of = np.searchsorted(off, self.start, "right") - 1
        piece = np.cumsum(_BREAK[buf])[self.start] if len(buf) else self.start
        same = (piece[1:] == piece[:-1]) & (self.of[1:] == self.of[:-1])
        self.behind = np.zeros(len(self.start), np.int64)
        for _ in range(LONGEST - 1):
            self.behind[:-1] = np.where(same, np.minimum(self.behind[1:] + 1, LONGEST - 1), 0)

    def names(self, langs: list[str], seed: int) -> np.ndarray:
        """64 bits for each word of a language."""
        own = np.array([xxhash.xxh64_intdigest(x.encode(), seed) for x in langs], U64)
        return mix(range_hash(self.texts.buf, self.start, self.end, seed) ^ own[self.of])


def _counted(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for a, b, texts in pieces(batch.column("text")):
                words = Words(texts)
                name, first, n = np.unique(words.names(langs[a:b], seed), return_index=True, return_counts=True)
                raw = words.texts.buf.tobytes()
                text = [raw[s:e] for s, e in zip(words.start[first].tolist(), words.end[first].tolist())]
                lang = [langs[a + k] for k in words.of[first].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(lang, pa.string()), pa.array(text, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=[c.split()[0] for c in WORDS.split(", ")])

    return run


def _frequent(words: DataFrame, least: int) -> np.ndarray:
    """The map of frequent words: FREQUENT_BITS bits, one of which each name has."""
    bit = (F.pmod("name", F.lit(FREQUENT_BITS)) + 1).alias("bit")  # numbers from 1 on
    rows = words.where(F.col("n") >= least).select(bit).groupBy(F.bitmap_bucket_number("bit").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(FREQUENT_BITS // 8, np.uint8)
    for k, bits in rows.toLocalIterator():  # parts of 4 KB, 1024 at most
        out[(k - 1) * 4096 : k * 4096] = np.frombuffer(bits, np.uint8)
    return out


def _projected(seed: int, buckets: int, frequent):
    """Pointers to the occurrences of each frequent word that has one behind it, packed by bucket."""

    def packed(names: list[np.ndarray], behind: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        name, at = np.concatenate(names), np.concatenate(behind)
        bit = (name.view(np.int64) % FREQUENT_BITS).astype(np.int64)
        some = np.append((frequent.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1, np.zeros(LONGEST, np.uint8)).astype(bool)
        first = np.flatnonzero((at > 0) & some[: len(at)] & some[1 : len(at) + 1])
        if not len(first):
            return
        known, place = np.unique(name[some[: len(name)]], return_inverse=True)
        place = np.append(place, 0)[np.cumsum(some[: len(name)]) - 1]  # of frequent words
        x = first + 1
        y = np.where((at[first] > 1) & some[first + 2], place[np.minimum(first + 2, len(place) - 1)] + 1, 0)
        bits = U64(max(1, int(len(known)).bit_length()))
        assert 3 * int(bits) <= 64  # as many as OCCURRENCES words are numbered
        code = (place[first].astype(U64) << (U64(2) * bits)) | (place[x].astype(U64) << bits) | y.astype(U64)
        code, n = np.unique(code, return_counts=True)
        mask = (U64(1) << bits) - U64(1)
        w, x, y = (code >> (U64(2) * bits)).astype(np.int64), ((code >> bits) & mask).astype(np.int64), (code & mask).astype(np.int64)
        bucket = (mix(known[w] * _STEP ^ known[x]) % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, w, x, y, n = bucket[order], w[order], x[order], y[order], n[order]
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        number, dictionaries, wide, codes = np.zeros(len(known) + 1, np.uint32), [], [], []
        for s, e in zip(cuts.tolist(), np.append(cuts[1:], len(bucket)).tolist()):
            own = np.unique(np.concatenate((w[s:e], x[s:e], y[s:e][y[s:e] > 0] - 1)))
            number[own + 1] = np.arange(1, len(own) + 1)
            dictionaries.append(known[own].tobytes())
            code = np.concatenate((number[w[s:e] + 1], number[x[s:e] + 1], np.where(y[s:e] > 0, number[y[s:e]], 0), n[s:e]))
            wide.append(int(code.max()) >= 1 << 16)
            codes.append(code.astype(np.uint32 if wide[-1] else np.uint16).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts]), pa.array(dictionaries, pa.binary()), pa.array(wide), pa.array(codes, pa.binary())], names=[c.split()[0] for c in PACKED.split(", ")])

    def parts(name: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A long text in parts; what follows a part's end comes along without pointers of its own."""
        for s in range(0, len(name), OCCURRENCES):
            e = s + OCCURRENCES
            own = at[s : e + LONGEST - 1].copy()
            own[OCCURRENCES:] = 0
            yield name[s : e + LONGEST - 1], own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, behind, held = [], [], 0
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for a, b, texts in pieces(batch.column("text")):
                words = Words(texts)
                for name, at in parts(words.names(langs[a:b], seed), words.behind):
                    if not at.any():
                        continue
                    if held and held + len(name) > OCCURRENCES:
                        yield from packed(names, behind)
                        names, behind, held = [], [], 0
                    names.append(name)
                    behind.append(at)
                    held += len(name)
        if held:
            yield from packed(names, behind)

    return run


def _sums(columns: tuple[np.ndarray, ...], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The head of each run of rows that are equal in all columns, and its number of occurrences."""
    head = np.zeros(len(n), bool)
    head[:1] = True
    for c in columns:
        head[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(head)
    return at, np.add.reduceat(n, at) if len(at) else n[:0]


def _grow(prefix: tuple[np.ndarray, ...], rest: tuple[np.ndarray, ...], n: np.ndarray, least: int) -> Iterator[tuple[tuple[np.ndarray, ...], np.ndarray]]:
    """Frequent patterns that begin with the prefixes: extended by the next word of their pointers, then grown further.

    Pointers are in order of prefix and rest; those of extensions that are not frequent are left behind.
    """
    if not rest:
        return
    some = rest[0] > 0
    grown = tuple(c[some] for c in (*prefix, rest[0]))
    rest, n = tuple(c[some] for c in rest[1:]), n[some]
    at, total = _sums(grown, n)
    keep = total >= least
    if not keep.any():
        return
    yield tuple(c[at[keep]] for c in grown), total[keep]
    rows = np.repeat(keep, np.diff(np.append(at, len(n))))
    yield from _grow(tuple(c[rows] for c in grown), tuple(c[rows] for c in rest), n[rows], least)


def _mined(least: int):
    def run(group: pa.Table) -> pa.Table:
        names = [np.frombuffer(x.as_py(), U64) for x in group.column("names")]
        known, place = np.unique(np.concatenate(names), return_inverse=True)
        off, parts = bounds_of(np.array([len(x) for x in names])), []
        for k, (x, wide) in enumerate(zip(group.column("codes"), group.column("wide").to_pylist())):
            code = np.frombuffer(x.as_py(), np.uint32 if wide else np.uint16).reshape(4, -1)
            own = np.append(0, place[off[k] : off[k + 1]] + 1)
            parts.append(np.stack((own[code[0]], own[code[1]], own[code[2]], code[3].astype(np.int64))))
        w, x, y, n = np.concatenate(parts, axis=1)
        bits = int(len(known) + 1).bit_length()
        order = np.argsort(((w << 2 * bits) | (x << bits) | y)) if 3 * bits < 63 else np.lexsort((y, x, w))
        w, x, y, n = w[order], x[order], y[order], n[order]
        out: list[list[np.ndarray]] = [[], [], [], []]
        cuts = np.append(np.flatnonzero(np.append(True, w[1:] != w[:-1]))[::PREFIXES], len(w))  # some prefixes at a time
        named = np.append(U64(0), known).view(np.int64)
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            for pattern, a in _grow((w[s:e],), (x[s:e], y[s:e]), n[s:e], least):
                padded = (*pattern, *(np.zeros(len(a), np.int64),) * (LONGEST - len(pattern)))
                for to, c in zip(out, (*(named[c] for c in padded), a)):
                    to.append(c)
        return pa.table({c.split()[0]: pa.array(np.concatenate(part) if part else np.zeros(0, np.int64), pa.int64()) for c, part in zip(GROWN.split(", "), out)})

    return run


def collocations(docs: DataFrame, least: int = LEAST, report: int = REPORT, absorbed: int = ABSORBED) -> DataFrame:
    """The first ``report`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
    ``[^\\x20\\x09]+``.  Phrases of two or three words of a piece count with all their occurrences,
    overlaps included; those with ``least`` of them are candidates.  A candidate cut into two parts with l and
    r occurrences scores floor(1000000 * a * a / (l * r)) by the cut that scores least, of equal ones the first.  It
    is dropped if a longer candidate holds it with 100 * its occurrences >= absorbed * a.  n is the number of
    words of the language.  Order: score and a from high to low, then phrase by bytes.

    Null texts are empty, a null lang is ``und``; doc_id is not looked at, so rows without one and repeated rows count.
    Texts are used whole, however long.  Languages without candidates, and an empty table, give no rows.  Other columns are ignored.
    """
    work = Workspace(docs.sparkSession, "phrases")
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    seed = 0
    while True:
        words = work.put(docs.mapInArrow(_counted(seed), WORDS).groupBy("name", "lang", "word").agg(F.sum("n").alias("n")), f"words-{seed}")
        shared = words.groupBy("name").count().where("count > 1 or name = 0").limit(1).count()
        if not shared:
            break
        seed += 1
    buckets = max(1, text_bytes(docs) // BUCKET_BYTES)
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(words, least))
    projected = docs.mapInArrow(_projected(seed, buckets, frequent), PACKED)
    grams = work.put(projected.groupBy("bucket").applyInArrow(_mined(least), GROWN), "grams")

    single = words.where(F.col("n") >= least).select("name", "lang", "word", F.col("n").alias("f"))
    pairs, triples = grams.where("y = 0").drop("y"), grams.where("y <> 0")
    one = lambda at: single.select(F.col("name").alias(at), F.col("f").alias(f"f_{at}"), F.col("word").alias(f"word_{at}"))
    two = lambda p, q: pairs.select(F.col("w").alias(p), F.col("x").alias(q), F.col("a").alias(f"f_{p}{q}"))
    score = lambda l, r: F.expr(f"(1000000BD * a * cast(a as decimal(19, 0))) div (cast({l} as decimal(19, 0)) * {r})")  # noqa: E731,E741
    holders = triples.select("w", "x", "a").unionByName(triples.select(F.col("x").alias("w"), F.col("y").alias("x"), "a")).groupBy("w", "x").agg(F.max("a").alias("longer"))
    short = pairs.join(holders, ["w", "x"], "left").where(f"longer is null or 100 * longer < {absorbed} * a").join(one("w"), "w").join(one("x"), "x")
    short = short.select("w", F.concat_ws(" ", "word_w", "word_x").alias("phrase"), "a", F.col("f_w").alias("l"), F.col("f_x").alias("r"), score("f_w", "f_x").alias("score"))
    long = triples.join(two("w", "x"), ["w", "x"]).join(two("x", "y"), ["x", "y"]).join(one("w"), "w").join(one("x"), "x").join(one("y"), "y")
    long = long.withColumn("cut", F.least(F.struct(score("f_w", "f_xy").alias("score"), F.lit(1).alias("k"), F.col("f_w").alias("l"), F.col("f_xy").alias("r")), F.struct(score("f_wx", "f_y").alias("score"), F.lit(2).alias("k"), F.col("f_wx").alias("l"), F.col("f_y").alias("r"))))
    long = long.select("w", F.concat_ws(" ", "word_w", "word_x", "word_y").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    scored = short.unionByName(long).join(single.select(F.col("name").alias("w"), "lang"), "w").drop("w")

    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(max(1, buckets // 8)))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= report)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= report)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("bigint").alias("score"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, unnest(w) AS x, unnest(w[2:]) AS y, unnest(w[3:]) AS z FROM worded),
counted AS (
  SELECT lang, 1 AS k, x AS phrase, count(*) AS f FROM placed GROUP BY ALL
  UNION ALL SELECT lang, 2, x || ' ' || y AS phrase, count(*) FROM placed WHERE y IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z AS phrase, count(*) FROM placed WHERE z IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
grams AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS p FROM counted WHERE f >= 10),
cuts AS (
  SELECT lang, k, phrase, f AS a, c.c, array_to_string(p[1 : c.c], ' ') AS x, array_to_string(p[c.c + 1 : k], ' ') AS y
  FROM grams, (VALUES (1), (2)) c(c) WHERE k > 1 AND c.c < k),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.c, x.f AS l, y.f AS r,
    (1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.x JOIN grams y ON y.lang = c.lang AND y.phrase = c.y),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, array_to_string(p[1 : 2], ' ') AS phrase, f FROM grams WHERE k = 3
    UNION ALL SELECT lang, array_to_string(p[2 : 3], ' ') AS phrase, f FROM grams WHERE k = 3) GROUP BY lang, phrase),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN longer t ON t.lang = s.lang AND t.phrase = s.phrase
  WHERE s.k = 3 OR t.f IS NULL OR 100 * t.f < 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
