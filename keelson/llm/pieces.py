"""SentencePiece ids of whole texts, from a table of distinct chunks.

The model marks each space with U+2581.  Its pieces hold that mark only at the
front (or are runs of it), so none crosses from another character to a mark; and none holds a line feed, which
falls back to a byte.  A marked text can therefore be cut before each run of
marks and around each line feed, and segmented chunk by chunk.  A task keeps
each distinct chunk once, with its ids, and joins the ids back by position with one ragged
gather.  ``ChunkTable.check`` proves the property for a model; a model without it is refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import U64, Texts, bounds_of, gather, pieces, range_hash
from .workspace import Workspace

MARK = "▁"
RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
FULL = f"{RESULT}, ids array<int>, decoded string"
#: Chunks kept by a task; beyond it the table starts afresh.
TABLE_CHUNKS = 500_000

_tables: dict[str, ChunkTable] = {}


class Ragged:
    """Rows of different lengths, appended to and gathered by row number."""

    def __init__(self, dtype):
        self.data, self.off, self.n, self.used = np.zeros(1 << 16, dtype), np.zeros(1 << 12, np.int64), 0, 0

    def extend(self, rows: np.ndarray, lens: np.ndarray) -> None:
        need, count = self.used + len(rows), self.n + len(lens)
        if need > len(self.data):
            self.data = np.concatenate([self.data[: self.used], np.zeros(need, self.data.dtype)])
        if count + 1 > len(self.off):
            self.off = np.concatenate([self.off[: self.n + 1], np.zeros(count + 1, np.int64)])
        self.data[self.used : need] = rows
        self.off[self.n + 1 : count + 1] = self.used + np.cumsum(lens)
        self.n, self.used = count, need

    def lens(self, at: np.ndarray) -> np.ndarray:
        return self.off[at + 1] - self.off[at]

    def take(self, at: np.ndarray) -> np.ndarray:
        return gather(self.data, self.off[at], self.lens(at))


class ChunkTable:
    """Distinct chunks of one model: ids, decimals of the ids, decoded bytes."""

    def __init__(self, model: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.check()
        self.feed = self.sp.encode("\n")[1]
        self.digits = Ragged(np.uint8)  # of each id, with a comma
        names = [f"{i},".encode() for i in range(len(self.sp))]
        self.digits.extend(np.frombuffer(b"".join(names), np.uint8), np.array([len(x) for x in names]))
        self.clear()

    @classmethod
    def of(cls, model: str) -> ChunkTable:
        if model not in _tables:
            _tables[model] = cls(model)
        return _tables[model]

    def check(self) -> None:
        sp = self.sp
        names = [sp.id_to_piece(i) for i in range(len(sp)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in names):
            raise ValueError("a piece crosses a whitespace marker or a line feed")
        if sp.id_to_piece(sp.encode("\n")[0]) != MARK or len(sp.encode("\n")) != 2:
            raise ValueError("the model must mark the start of a text and fall back to bytes")

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.decimals, self.decoded = Ragged(np.int32), Ragged(np.uint8), Ragged(np.uint8)

    def rows(self, chunks: list[bytes]) -> np.ndarray:
        """Row numbers of chunks; the ones not seen before are segmented."""
        if len(self.known) + len(chunks) > TABLE_CHUNKS:
            self.clear()
        new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        if new:
            self._segment([c for c in new if c != b"\n"])
            if b"\n" in new:
                new = [*(c for c in new if c != b"\n"), b"\n"]
                self._append(np.array([self.feed], np.int32), np.array([1]), np.array([10], np.uint8), np.array([1]))
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        return np.array([self.known[c] for c in chunks], np.int64)

    def _segment(self, chunks: list[bytes]) -> None:
        """Segments chunks in groups set apart by line feeds, which no piece crosses."""
        groups = [chunks[k : k + 2000] for k in range(0, len(chunks), 2000)]
        # The first line feed takes the mark that the library puts before a text.
        encoded = self.sp.encode([b"\n" + b"\n".join(g) for g in groups], num_threads=1)
        for group, ids, text in zip(groups, encoded, self.sp.decode(encoded, num_threads=1)):
            ids, out = np.array(ids[1:], np.int32), np.frombuffer(text.encode(), np.uint8)
            at, cut = (np.append(np.flatnonzero(x == feed), len(x)) for x, feed in ((ids, self.feed), (out, 10)))
            if not len(at) == len(cut) == len(group) + 1:
                raise ValueError("line feeds must stay apart")
            self._append(ids[ids != self.feed], np.diff(at) - 1, out[out != 10], np.diff(cut) - 1)

    def _append(self, ids, count, out, size) -> None:
        self.ids.extend(ids, count)
        self.decoded.extend(out, size)
        digits = self.digits.lens(ids)
        self.decimals.extend(self.digits.take(ids), np.diff(bounds_of(digits)[bounds_of(count)]))

    def segment(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(table row of each chunk, offsets of the texts in chunks)."""
        marked, off = _marked(texts)
        buf, n = marked, len(marked)
        if not n:
            return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
        space, feed = buf == 32, buf == 10
        head = np.zeros(n, bool)
        head[0] = True
        head[1:] = (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
        head[off[:-1][np.diff(off) > 0]] = True
        starts = np.flatnonzero(head)
        ends = np.append(starts[1:], n)
        key = range_hash(buf, starts, ends)
        order = np.argsort(key, kind="stable")
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[order][1:] != key[order][:-1]
        which = np.empty(len(key), np.int64)
        which[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        raw = buf.tobytes()
        chunks = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
        # A chunk is the one that its key stands for only if their bytes are the same.
        lens = ends - starts
        wrong = lens != lens[first[which]]
        unlike = np.flatnonzero(gather(np.append(buf, np.zeros(int(lens.max()), np.uint8)), starts[first[which]], lens) != buf)
        wrong[np.searchsorted(starts, unlike, "right") - 1] = True
        for k in np.flatnonzero(wrong).tolist():
            which[k] = len(chunks)
            chunks.append(raw[starts[k] : ends[k]])
        rows = self.rows(chunks)[which]
        return rows, np.searchsorted(starts, off)


def _marked(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Texts with the leading mark that the library adds (none before an empty text); marks are spaces."""
    raw = texts.buf.tobytes()
    if MARK.encode() in raw:  # a mark in a text is a space to the model
        parts = [raw[s:e].replace(MARK.encode(), b" ") for s, e in zip(texts.off[:-1], texts.off[1:])]
        texts = Texts(np.frombuffer(b"".join(parts), np.uint8), bounds_of([len(p) for p in parts]))
    lens = np.diff(texts.off)
    some = lens > 0
    off = bounds_of(lens + some)
    out = np.full(int(off[-1]), 32, np.uint8)
    keep = np.ones(len(out), bool)
    keep[off[:-1][some]] = False
    out[keep] = texts.buf
    return out, off


def _encoded(model: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable.of(model)
        for batch in batches:
            for a, b, texts in pieces(batch.column("text"), 1 << 20):
                rows, at = table.segment(texts)
                ids_off, dec_off, out_off = (bounds_of(t.lens(rows))[at] for t in (table.ids, table.decimals, table.decoded))
                digits, out = table.decimals.take(rows).tobytes(), table.decoded.take(rows).tobytes()
                decoded = [out[s:e][1:] for s, e in zip(out_off[:-1], out_off[1:])]  # without the leading mark
                columns = {
                    "doc_id": batch.column("doc_id").slice(a, b - a),
                    "n_tokens": pa.array(np.diff(ids_off), pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(digits[s : max(s, e - 1)]).hexdigest() for s, e in zip(dec_off[:-1], dec_off[1:])]),
                    "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
                }
                if full:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(ids_off, pa.int32()), pa.array(table.ids.take(rows)))
                    columns["decoded"] = pa.array(decoded, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def encode_texts(docs: DataFrame, model: str, full: bool = True) -> DataFrame:
    """One row per document: number of ids, digests of the ids and of the text decoded from them.

    Ids are those of the sentencepiece library for the whole text, without begin or
    end ids; ``full`` adds the ids and the decoded text themselves.  Null and empty
    texts have no ids and decode to the empty text.  Rows keep their doc_id, null or
    repeated; other columns are ignored; an empty table gives an empty result.
    """
    Workspace(docs.sparkSession, "pieces")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return docs.mapInArrow(_encoded(model, full), FULL if full else RESULT)
