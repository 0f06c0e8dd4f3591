"""Quality rules from tokeniser fertility.

How a public vocabulary takes a text apart tells prose from noise: characters per token, the
share of tokens that are single bytes, and the entropy of the tokens.
What is usual differs by language, so each has its own rejection bands
(Tukey's outer fences around the quartiles of its documents).  A language of too few documents to tell what
is usual, and documents without one, are banded by the script that most of their letters belong to, and a script of too few by all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .docstats import _group_counts, base_counts
from .pieces import ChunkTable
from .textbatch import U64, Texts, bounds_of, pieces
from .workspace import Workspace

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Quartile distances beyond the quartiles that a measure may lie, and its least distance from the median (a share of it).
FENCE, SLACK = 3.0, 0.05
#: Documents that the base rules pass which a language or a script needs for bands of its own.
LEAST = 30
#: Where scripts begin in the order of code points; "" for what lies between them.
SCRIPTS = (
    (0x0, ""), (0x41, "latin"), (0x5B, ""), (0x61, "latin"), (0x7B, ""), (0xC0, "latin"), (0xD7, ""), (0xD8, "latin"), (0xF7, ""), (0xF8, "latin"), (0x250, ""),
    (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, ""), (0x750, "arabic"), (0x780, ""), (0x900, "devanagari"),
    (0x980, "bengali"), (0xA00, "gurmukhi"), (0xA80, "gujarati"), (0xB00, ""), (0xB80, "tamil"), (0xC00, "telugu"), (0xC80, "kannada"), (0xD00, "malayalam"), (0xD80, ""),
    (0xE00, "thai"), (0xE80, ""), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, ""), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""),
    (0x3040, "kana"), (0x3100, ""), (0x3400, "han"), (0x4DC0, ""), (0x4E00, "han"), (0xA000, ""), (0xAC00, "hangul"), (0xD7B0, ""), (0x20000, "han"), (0x32000, ""),
)
_NAMES = sorted({name for _, name in SCRIPTS} - {""})
_STARTS = np.array([start for start, _ in SCRIPTS])
_NUMBERS = np.array([_NAMES.index(name) if name else len(_NAMES) for _, name in SCRIPTS])
#: Quartiles are exact on values binned this finely.
BINS = 1000
MEASURES = {"chars_per_token": (True, True), "byte_share": (False, True), "token_entropy": (True, False)}  # which sides reject
METRICS = (
    "doc_id bigint, lang string, script string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_tokens bigint, chars_per_token double, byte_share double, token_entropy double"
)


def scripts(texts: Texts) -> np.ndarray:
    """The script of most letters of each text, the first by name of equals, "none" without letters."""
    at = np.flatnonzero((texts.buf & 0xC0) != 0x80)
    lead = texts.buf[at].astype(np.int32)
    length = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    code = np.where(length == 1, lead, lead & (0xFF >> (length + 1)))
    for k in (1, 2, 3):
        on = np.flatnonzero(length > k)
        code[on] = code[on] << 6 | (texts.buf[at[on] + k] & 0x3F)
    kind = _NUMBERS[np.searchsorted(_STARTS, code, "right") - 1]
    of = np.searchsorted(texts.off, at, "right") - 1
    letters = np.bincount(of * (len(_NAMES) + 1) + kind, minlength=(len(texts.off) - 1) * (len(_NAMES) + 1)).reshape(-1, len(_NAMES) + 1)[:, :-1]
    return np.where(letters.any(axis=1), np.array(_NAMES)[letters.argmax(axis=1)], "none")


def _measured(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable.of(model)
        is_byte = np.array([table.sp.is_byte(i) for i in range(len(table.sp))])
        for batch in batches:
            for a, b, texts in pieces(batch.column("text"), 1 << 20):
                base = base_counts(texts)
                rows, at = table.segment(texts)
                ids, off = table.ids.take(rows), bounds_of(table.ids.lens(rows))[at]
                n = np.diff(off)
                of = np.repeat(np.arange(len(n)), n)
                times, _ = _group_counts(ids.astype(U64), of)
                some = np.maximum(n, 1)
                entropy = np.log2(some) - np.bincount(of, np.log2(times), minlength=len(n)) / some
                chars = np.diff(bounds_of((texts.buf & 0xC0) != 0x80)[texts.off])
                columns = {"doc_id": batch.column("doc_id").slice(a, b - a), "lang": batch.column("lang").slice(a, b - a), "script": pa.array(scripts(texts), pa.string())}
                columns |= {k: pa.array(v, pa.int64()) for k, v in base.items()} | {"n_tokens": pa.array(n, pa.int64())}
                columns |= {
                    "chars_per_token": pa.array(chars / some),
                    "byte_share": pa.array(np.bincount(of, is_byte[ids], minlength=len(n)) / some),
                    "token_entropy": pa.array(np.maximum(entropy, 0.0)),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def bands(measured: DataFrame) -> DataFrame:
    """(group, band): the least and largest value of each measure that is kept (low_<measure>, high_<measure>).

    Groups are languages (lang:...), scripts (script:...) and all; of languages and scripts those of ``LEAST`` documents and more.
    """
    groups = F.array(F.concat(F.lit("lang:"), "lang"), F.concat(F.lit("script:"), "script"), F.lit("all"))
    measured = measured.select(*MEASURES, F.explode(F.array_compact(groups)).alias("group"))
    bins = measured.select(
        "group",
        F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) * BINS).alias("bin")) for m in MEASURES))).alias("x"),
    ).groupBy("group", "x.measure", "x.bin").count()
    w = Window.partitionBy("group", "measure")
    ranked = bins.withColumn("upto", F.sum("count").over(w.orderBy("bin"))).withColumn("total", F.sum("count").over(w))
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bin"))) / F.lit(float(BINS))
    quartiles = ranked.groupBy("group", "measure").agg(F.max("total").alias("total"), *(quartile(q).alias(f"q{q}") for q in (1, 2, 3)))
    reach = F.greatest((F.col("q3") - F.col("q1") + F.lit(1.0 / BINS)) * FENCE, F.lit(0.0))
    fenced = quartiles.select(
        "group",
        "measure",
        "total",
        F.least(F.col("q1") - reach, F.col("q2") * (1 - SLACK)).alias("low"),
        F.greatest(F.col("q3") + reach, F.col("q2") * (1 + SLACK)).alias("high"),
    )
    return fenced.groupBy("group").agg(
        F.struct(*(F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{side}_{m}") for m in MEASURES for side in ("low", "high"))).alias("band"), F.max("total").alias("n")
    ).where((F.col("n") >= LEAST) | (F.col("group") == "all")).drop("n")


def judge(docs: DataFrame, model: str) -> DataFrame:
    """One row per document: base counts, measures, base_failed and kept.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated
    three-word windows.  ``kept``: base_failed is false and characters per token,
    byte share (only too high) and token entropy (only too low) lie in the bands
    of the document's language, which are taken from all documents of that language
    that the base rules pass.  Where lang is null or missing, or has fewer than 30 such documents, the bands of the
    document's script hold, and those of all documents where that has fewer than 30 too.
    Values on a fence are kept; of several scripts with equally many letters the first by name holds.

    Null texts have no words and fail.  Texts are taken whole, however long; a long one is measured by itself.
    Rows keep their doc_id, null or repeated; other columns are ignored; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession, "fertility")
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), lang.alias("lang"))
    measured = work.put(
        docs.mapInArrow(_measured(model), METRICS).withColumn(
            "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
        ),
        "measured",
    )
    limits = work.put(bands(measured.where(~F.col("base_failed"))), "bands")
    named = lambda kind: limits.where(F.col("group").startswith(f"{kind}:")).select(F.substr("group", F.lit(len(kind) + 2)).alias(kind), F.col("band").alias(f"by_{kind}"))
    every = limits.where("group = 'all'").select(F.col("band").alias("by_all"))
    placed = measured.join(named("lang"), "lang", "left").join(named("script"), "script", "left").join(F.broadcast(every), how="left")  # one row at most
    placed = placed.withColumn("band", F.coalesce("by_lang", "by_script", "by_all"))
    inside = [F.col(m) >= F.col(f"band.low_{m}") for m, (low, _) in MEASURES.items() if low]
    inside += [F.col(m) <= F.col(f"band.high_{m}") for m, (_, high) in MEASURES.items() if high]
    kept = ~F.col("base_failed") & F.coalesce(reduce(lambda a, b: a & b, inside), F.lit(False))
    return placed.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"),
        "script", "n_tokens", *MEASURES,
    )
