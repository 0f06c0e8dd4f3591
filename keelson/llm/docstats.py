"""Counts of whole documents that rules and classifiers share, worked out for many texts at a time."""

from __future__ import annotations

import numpy as np

from .textbatch import U64, Texts, bounds_of, mix, range_hash, sequence_hash

SYMBOLS = b"#*$%&|<>"


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(bounds_of(values)[off])


def _group_counts(keys: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(times each key stands in its text, whether it stood there before)."""
    key = mix(keys + mix(of.astype(U64)))
    order = np.argsort(key, kind="stable")
    head = np.ones(len(key), bool)
    head[1:] = key[order][1:] != key[order][:-1]
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, len(key)))
    count, again = np.empty(len(key), np.int64), np.empty(len(key), bool)
    count[order] = np.repeat(size, size)
    again[order] = ~head
    return count, again


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int32)
    change[starts] += 1
    change[starts + width] -= 1
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text (int64).

    Words are ``[^\\x20\\x09-\\x0D]+``; duplicate lines are lines with a word that equal an
    earlier line of the text; repeated words stand in a window of three words found twice or more.
    """
    return {k: v for k, v in _counts(texts).items() if not k.startswith("_")}


def _counts(texts: Texts) -> dict[str, np.ndarray]:
    joined, starts, ends, woff = texts.joined()
    n_words = np.diff(woff)
    of = np.repeat(np.arange(len(texts)), n_words)
    lead = (texts.buf & 0xC0) != 0x80
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True

    word = range_hash(joined.buf, starts, ends)
    last = np.repeat(woff[1:], n_words)
    window = np.flatnonzero(np.arange(len(of)) + 3 <= last)
    times, _ = _group_counts(sequence_hash(word, window, 3), of[window])
    repeated = _covered(window[times > 1], 3, len(of))

    feed = texts.buf == 10
    head = np.zeros(len(feed) + 1, bool)
    head[1:] = feed
    head[texts.off[:-1]] = True
    line = np.flatnonzero(head[:-1]) if len(feed) else np.zeros(0, np.int64)
    loff = np.searchsorted(line, texts.off)
    stop = np.append(line[1:], len(feed))
    stop = stop - (feed[np.minimum(stop - 1, len(feed) - 1)] if len(feed) else 0)
    own, _, word_off = texts.words()
    has_word = np.searchsorted(own, stop) > np.searchsorted(own, line)
    line_of = np.repeat(np.arange(len(texts)), np.diff(loff))
    kept = np.flatnonzero(has_word)
    _, again = _group_counts(range_hash(texts.buf, line[kept], stop[kept]), line_of[kept])
    dup = np.zeros(len(line), bool)
    dup[kept] = again
    return {
        "n_words": n_words,
        "word_chars": np.diff(bounds_of((joined.buf & 0xC0) != 0x80)[joined.off]) - n_words,
        "n_symbols": _sums(is_symbol[texts.buf], texts.off),
        "n_dup_lines": _sums(dup, loff),
        "n_repeat_words": _sums(repeated, woff),
        "_chars": _sums(lead, texts.off),
        "_lines": np.diff(loff),
        "_word_hash": word,
        "_word_len": ends - starts,
        "_word_of": of,
        "_word_off": woff,
    }


#: Inputs of the quality classifier, in order.
FEATURES = (
    "log_words", "log_chars", "mean_word", "max_word", "symbols", "dup_lines", "repeat_words", "upper", "digits", "punctuation",
    "spaces", "exclaims", "pipes", "wide", "distinct_words", "top_word", "words_a_line", "line_feeds", "upper_words", "ends_symbol",
)


def features(texts: Texts) -> np.ndarray:
    """FEATURES of each text (float64, one row per text; an empty text is a row of zeros)."""
    c = _counts(texts)
    n, chars = np.maximum(c["n_words"], 1), np.maximum(c["_chars"], 1)
    size = np.maximum(np.diff(texts.off), 1)
    buf, off, of, woff = texts.buf, texts.off, c["_word_of"], c["_word_off"]

    def share(flag: np.ndarray) -> np.ndarray:
        return _sums(flag, off) / size

    upper = (buf >= 65) & (buf <= 90)
    punctuation = np.isin(buf, np.frombuffer(b".,;:!?'\"()-", np.uint8))
    times, again = _group_counts(c["_word_hash"], of)
    some = np.flatnonzero(c["n_words"])
    top, longest = np.zeros(len(n)), np.zeros(len(n))
    if len(some):
        top[some] = np.maximum.reduceat(times, woff[:-1][some])
        longest[some] = np.maximum.reduceat(c["_word_len"], woff[:-1][some])
    starts, ends, _ = texts.words()
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS + b"!")] = True
    columns = (
        np.log1p(c["n_words"]), np.log1p(c["_chars"]), c["word_chars"] / n, longest, c["n_symbols"] / chars, c["n_dup_lines"] / np.maximum(c["_lines"], 1),
        c["n_repeat_words"] / n, share(upper), share((buf >= 48) & (buf <= 57)), share(punctuation), share(buf == 32), share(buf == 33), share(buf == 124),
        share(buf >= 128), _sums(~again, woff) / n, top / n, n / np.maximum(c["_lines"], 1), share(buf == 10),
        _sums(upper[starts] & upper[ends - 1] if len(starts) else starts, woff) / n, _sums(is_symbol[buf[ends - 1]] if len(starts) else starts, woff) / n,
    )
    out = np.stack(columns, axis=1).astype(np.float64)
    out[np.diff(off) == 0] = 0
    return out
