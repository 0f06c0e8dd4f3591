"""Numpy views over batches of UTF-8 texts: words, range hashes, ragged gathers.

A task sees an Arrow string column; ``pieces`` cuts it into runs of whole rows
of a few MB, so the work arrays stay small however long the batch is (a single
longer text makes a piece of its own).  Nulls are read as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
PIECE_BYTES = 4 << 20
#: The separators of ``[^\x20\x09-\x0D]+``.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over all 64."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def ragged(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after the other."""
    counts = np.asarray(counts, np.int64)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) - np.repeat(ends - counts, counts)


def gather(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """data[s:s+l] for each start and length, concatenated."""
    return data[np.repeat(starts, lens) + ragged(lens)]


def bounds_of(lens: np.ndarray) -> np.ndarray:
    """Offsets (one more than lengths) of consecutive runs."""
    out = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=out[1:])
    return out


class Texts:
    """Whole texts side by side: ``buf[off[k]:off[k + 1]]`` is text k."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off = buf, off

    def __len__(self) -> int:
        return len(self.off) - 1

    def lower(self) -> Texts:
        """A-Z lower-cased, other bytes unchanged."""
        up = (self.buf >= 65) & (self.buf <= 90)
        return Texts(self.buf + up.astype(np.uint8) * np.uint8(32), self.off)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text offsets (in words) of ``[^\\x20\\x09-\\x0D]+``."""
        word = ~_SPACE[self.buf]
        edge = np.zeros(len(word) + 1, bool)
        edge[1:-1] = word[1:] != word[:-1]
        cut = self.off[(self.off > 0) & (self.off < len(word))]
        starts_at = edge.copy()
        starts_at[cut] = True
        ends_at = starts_at.copy()
        starts_at[0] = True
        ends_at[-1] = True
        starts = np.flatnonzero(starts_at[:-1] & word) if len(word) else np.zeros(0, np.int64)
        ends = np.flatnonzero(ends_at[1:] & word) + 1 if len(word) else np.zeros(0, np.int64)
        return starts, ends, np.searchsorted(starts, self.off)

    def joined(self) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray]:
        """The same words with one space between words of a text; starts, ends, text offsets in words."""
        starts, ends, woff = self.words()
        lens = ends - starts
        new = bounds_of(lens + 1)
        take = np.repeat(starts, lens + 1) + ragged(lens + 1)
        buf = np.append(self.buf, np.uint8(32))[np.minimum(take, len(self.buf))]
        buf[new[1:] - 1] = 32
        return Texts(buf, new[woff]), new[:-1], new[1:] - 1, woff


#: Ranges up to this length are hashed together, longer ones one by one.
_SHORT = 64
_STEP = U64(0x9E3779B97F4A7C15)
_LOW = np.array([2 ** (8 * k) - 1 for k in range(8)], U64)


def _eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number; zeros stand behind the end."""
    padded = np.append(buf, np.zeros(8, np.uint8))
    return np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))


def range_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of bytes [start, end), the same wherever the bytes stand: eight bytes at a time, mixed after each step."""
    starts, lens = np.asarray(starts, np.int64), np.asarray(ends - starts, np.int64)
    out, view = mix(lens.astype(U64) + U64(int(_STEP) * (seed + 1) % 2**64)), _eights(buf)
    left = np.flatnonzero((lens > 0) & (lens <= _SHORT))
    at, rest, state = starts[left], lens[left], out[left]
    while len(left):
        part, end = view[at].astype(U64), np.flatnonzero(rest < 8)
        part[end] &= _LOW[rest[end]]
        state = mix((state ^ part) * _STEP)
        more = rest > 8
        done = ~more
        out[left[done]] = state[done]
        left, at, rest, state = left[more], at[more] + 8, rest[more] - 8, state[more]
    whole = memoryview(np.ascontiguousarray(buf))
    for k in np.flatnonzero(lens > _SHORT).tolist():
        out[k] = xxhash.xxh3_64_intdigest(whole[starts[k] : starts[k] + lens[k]], seed)
    return out


def window_hash(buf: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the ``length`` bytes from each start on (all inside buf)."""
    if length < 8:
        return range_hash(buf, starts, starts + length), range_hash(buf, starts, starts + length, 1)
    places = [*range(0, length - 7, 8)] + ([length - 8] if length % 8 else [])  # the last eight may overlap
    view, out = _eights(buf), (np.empty(len(starts), U64), np.empty(len(starts), U64))
    for s in range(0, len(starts), 1 << 14):  # work arrays stay in the cache
        at = starts[s : s + (1 << 14)]
        a, b = np.full(len(at), _STEP), np.full(len(at), U64(length))
        for k in places:
            part = view[at + k]
            a ^= part
            a *= U64(0xFF51AFD7ED558CCD)
            a ^= a >> U64(32)
            b += part
            b *= U64(0xC4CEB9FE1A85EC53)
            b ^= b >> U64(29)
        out[0][s : s + len(at)], out[1][s : s + len(at)] = mix(a), mix(b)
    return out


def sequence_hash(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n hashes from each place on."""
    state = np.full(len(at), U64(int(_STEP) * n % 2**64))
    for k in range(n):
        state = mix((state ^ hashes[at + k]) * _STEP)
    return state


def pieces(column: pa.Array | pa.ChunkedArray, max_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, texts) for runs of whole rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, "right")) - 1)
        yield at, end, Texts(data[off[at] : off[end]], off[at : end + 1] - off[at])
        at = end


_P = [U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def _read(padded: np.ndarray, dtype: str, at: np.ndarray) -> np.ndarray:
    view = np.ndarray((len(padded) - 7,), dtype, padded, strides=(1,))
    return view[at].astype(U64)


def xxh64(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of each byte range, all ranges at a time."""
    p1, p2, p3, p4, p5 = _P
    padded = np.append(buf, np.zeros(40, np.uint8))
    lens = np.asarray(lens, np.int64)
    at = np.asarray(starts, np.int64).copy()
    h = np.full(len(lens), U64((seed + int(p5)) % 2**64), U64)
    live = np.flatnonzero(lens >= 32)
    if len(live):
        acc = [np.full(len(live), U64((seed + x) % 2**64), U64) for x in (int(p1) + int(p2), int(p2), 0, -int(p1))]
        stripes, pos, step = lens[live] // 32, at[live], 0
        while True:
            on = np.flatnonzero(stripes > step)
            if not len(on):
                break
            for k in range(4):
                acc[k][on] = _rotl(acc[k][on] + _read(padded, "<u8", pos[on] + 8 * k) * p2, 31) * p1
            pos[on] += 32
            step += 1
        s = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for a in acc:
            s = (s ^ (_rotl(a * p2, 31) * p1)) * p1 + p4
        h[live], at[live] = s, pos
    h += lens.astype(U64)
    rest = lens % 32
    for k in range(3):
        on = np.flatnonzero(rest >= 8 * (k + 1))
        if len(on):
            h[on] = _rotl(h[on] ^ (_rotl(_read(padded, "<u8", at[on]) * p2, 31) * p1), 27) * p1 + p4
            at[on] += 8
    on = np.flatnonzero(rest % 8 >= 4)
    h[on] = _rotl(h[on] ^ (_read(padded, "<u4", at[on]) * p1), 23) * p2 + p3
    at[on] += 4
    for k in range(3):
        on = np.flatnonzero(rest % 4 > k)
        h[on] = _rotl(h[on] ^ (padded[at[on]].astype(U64) * p5), 11) * p1
        at[on] += 1
    h ^= h >> U64(33)
    h *= p2
    h ^= h >> U64(29)
    h *= p3
    h ^= h >> U64(32)
    return h
