"""CSV and TSV files of any size, read by byte ranges of many tasks.

Spark cuts the files into blocks of whole lines.  A line feed may stand in a quoted cell, so a block may begin inside a record.
A first pass works out, for a block that would begin outside and one that would begin inside a quoted cell, how it ends
and how many records begin in it; from that follows, block after block of a file, how each one really begins and the number of its first
record.  A second pass reads the records.  What of a record stands in other blocks comes as fragments, which are put together.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.store import stored

ENCODINGS = ("utf-8", "gbk", "latin-1")
#: The longest cell.
CELL_CHARS = 1 << 30
#: Records, and bytes of them, that are handed on at a time.
CHUNK_ROWS, CHUNK_BYTES = 20_000, 16 << 20
BLOCKS = "path string, start bigint, rows_out bigint, to_out int, rows_in bigint, to_in int, utf8 boolean, gbk boolean"
RESOLVED = "path string, start bigint, inside boolean, base bigint, encoding string"
PARSED = "path string, start bigint, place bigint, cells array<binary>, fragment binary, opens boolean"
BOM = b"\xef\xbb\xbf"


def _separator(path: str) -> str:
    return "\t" if path.lower().endswith(".tsv") else ","


def _end(line: bytes, separator: bytes, inside: bool, at_return: bool = False) -> bool | int:
    """Whether the line feed behind a line stands inside a quoted cell; with ``at_return``, the place of the first carriage return outside of one, or the length."""
    at, quoted = 0, inside
    while True:
        if not quoted:
            if line[at : at + 1] == b'"':
                quoted, at = True, at + 1
                continue
        else:
            close = line.find(b'"', at)
            if close < 0:
                return len(line) if at_return else True
            if line[close + 1 : close + 2] == b'"':
                at = close + 2
                continue
            quoted, at = False, close + 1
        ends = [k for k in (line.find(separator, at), line.find(b"\r", at)) if k >= 0]
        if not ends or (at_return and line[min(ends) : min(ends) + 1] == b"\r"):
            return (min(ends) if ends else len(line)) if at_return else False
        at = min(ends) + 1


def _records(text: bytes, separator: str) -> list[list[bytes]]:
    """The records of a text that begins and ends outside quotes; blank ones are left out.  Bytes stand for characters meanwhile."""
    plain = text.rstrip(b"\r")
    if b'"' not in plain and b"\r" not in plain:
        return [plain.split(separator.encode())] if plain else []
    csv.field_size_limit(CELL_CHARS)
    rows = csv.reader(io.StringIO(text.decode("latin-1"), newline=""), delimiter=separator)
    return [[cell.encode("latin-1") for cell in row] for row in rows if row]


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[bytes]]]:
    """(path, start, lines) of each run of lines of one block in a batch."""
    for batch in batches:
        paths, starts, lines = (batch.column(c).to_pylist() for c in ("path", "start", "line"))
        at = 0
        while at < len(lines):
            end = at + 1
            while end < len(lines) and starts[end] == starts[at] and paths[end] == paths[at]:
                end += 1
            yield paths[at], starts[at], lines[at:end]
            at = end


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(key, s) -> pa.RecordBatch:
        values = [key[0], key[1], s[0][0], int(s[0][1]), s[1][0], int(s[1][1]), s[2], s[3]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    key, state = None, None
    for path, start, lines in _by_block(batches):
        if key != (path, start):
            if key is not None:
                yield row(key, state)
            key, state = (path, start), [[0, False], [0, True], True, True]
        separator = _separator(path)
        for line in lines:
            state[2] = state[2] and _decodes(line, "utf-8")
            state[3] = state[3] and _decodes(line, "gbk")
            for s in state[:2]:
                inside = s[1]
                s[1] = _end(line, separator.encode(), inside) if b'"' in line else inside
                if b"\r" in line.rstrip(b"\r"):  # records may be parted by carriage returns too
                    s[0] += len(_records((b'"' if inside else b"") + line, separator)) - inside
                elif not inside:
                    s[0] += bool(line.rstrip(b"\r"))
    if key is not None:
        yield row(key, state)


def _decodes(line: bytes, encoding: str) -> bool:
    if line.isascii():
        return True
    try:
        line.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def _resolved(group: pa.Table) -> pa.Table:
    """How each block of a file begins."""
    rows = sorted(group.to_pylist(), key=lambda r: r["start"])
    # An incomplete character at the end of a line is found by the encoding that every line of the file fits.
    encoding = next(e for e, fits in zip(ENCODINGS, (all(r["utf8"] for r in rows), all(r["gbk"] for r in rows), True)) if fits)
    inside, base, out = False, 0, []
    for r in rows:
        out.append({"path": r["path"], "start": r["start"], "inside": inside, "base": base, "encoding": encoding})
        base += r["rows_in"] if inside else r["rows_out"]
        inside = bool(r["to_in"] if inside else r["to_out"])
    return pa.Table.from_pylist(out, pa.schema([("path", pa.string()), ("start", pa.int64()), ("inside", pa.bool_()), ("base", pa.int64()), ("encoding", pa.string())]))


def _parsed(inside_at: frozenset):
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("place", pa.int64()), ("cells", pa.list_(pa.binary())), ("fragment", pa.binary()), ("opens", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, separator, inside, held, place = None, ",", False, [], 0
        out, size = [], 0

        def put(cells, fragment=None, opens=False):
            nonlocal place, size
            out.append({"path": key[0], "start": key[1], "place": place, "cells": cells, "fragment": fragment, "opens": opens})
            place += cells is not None or opens
            size += len(fragment or b"") + sum(map(len, cells or ()))

        def finish():
            if inside:  # goes on in the next block
                put(None, b"\n".join(held), not open_before)

        for path, start, lines in _by_block(batches):
            if key != (path, start):
                if key is not None:
                    finish()
                key, separator, place, held = (path, start), _separator(path), 0, []
                inside = open_before = key in inside_at
                if start == 0 and lines[0].startswith(BOM):
                    lines[0] = lines[0][len(BOM) :]
            for line in lines:
                was, inside = inside, _end(line, separator.encode(), inside) if b'"' in line else inside
                if was or inside:
                    held.append(line)
                if inside:
                    continue
                if was and open_before:
                    text = b"\n".join(held)
                    close = _end(text, separator.encode(), True, True)
                    put(None, text[:close])
                    for cells in _records(text[close + 1 :], separator):
                        put(cells)
                else:
                    for cells in _records(b"\n".join(held) if was else line, separator):
                        put(cells)
                held, open_before = [], False
                if len(out) >= CHUNK_ROWS or size >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
        if key is not None:
            finish()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The record that some fragments make, in bytes."""
    for batch in batches:
        cells = [_records(text, _separator(path)) for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist())]
        first = pa.array([c[0] if c else [] for c in cells], pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("start"), batch.column("place"), first], names=["path", "start", "place", "cells"])


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [[c.decode(e) for c in row] for row, e in zip(batch.column("cells").to_pylist(), batch.column("encoding").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("row_index"), pa.array(cells, pa.list_(pa.string()))], names=["path", "row_index", "cells"])


def records(spark: SparkSession, where: str | list[str], pattern: str) -> DataFrame:
    """(path, row_index, cells) of the records of CSV and TSV files: of all below a folder, or of those named.

    Records keep their own number of cells; blank ones are left out and not counted.  A file's encoding is UTF-8 (with or without a mark), if all of it is, else
    GBK, else Latin-1.  Whether a block begins inside a record is known to all tasks (a name per such block: few, and one for each 128 MB at most).
    """
    if not isinstance(where, str):
        where = [x for x in where if x.lower().endswith((".csv", ".tsv"))]
        if not where:
            return spark.createDataFrame([], "path string, row_index int, cells array<string>")
    source = spark.read.format("text").option("lineSep", "\n").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(where)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    lines = source.where(~name.rlike(r"^[.~]")).select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    blocks = stored(lines.mapInArrow(_blocks, BLOCKS), "blocks")
    resolved = stored(blocks.groupBy("path").applyInArrow(_resolved, RESOLVED), "resolved")
    inside = frozenset((r["path"], r["start"]) for r in resolved.where("inside").select("path", "start").toLocalIterator())
    parsed = stored(lines.mapInArrow(_parsed(inside), PARSED), "parsed")
    whole = parsed.where("cells is not null").select("path", "start", "place", "cells")
    w = Window.partitionBy("path").orderBy("start", "opens")
    parts = parsed.where("fragment is not null").withColumn("record", F.sum(F.col("opens").cast("int")).over(w))
    # A block's last fragment opens a record; the ones of the next blocks, up to one that does, belong to it.
    made = parts.groupBy("path", "record").agg(
        F.min_by("start", F.struct("start", "opens")).alias("start"), F.max(F.when(F.col("opens"), F.col("place"))).alias("place"),
        F.array_sort(F.collect_list(F.struct("start", "fragment"))).alias("all"),
    )
    text = F.aggregate(F.slice("all", 2, F.size("all")), F.element_at("all", 1)["fragment"], lambda s, x: F.concat(s, F.lit(b"\n"), x["fragment"]))
    made = made.select("path", "start", "place", text.alias("text")).mapInArrow(_joined, "path string, start bigint, place bigint, cells array<binary>").where("size(cells) > 0")
    rows = whole.unionByName(made).join(resolved, ["path", "start"]).select("path", (F.col("base") + F.col("place")).cast("int").alias("row_index"), "cells", "encoding")
    utf8 = rows.where("encoding = 'utf-8'").select("path", "row_index", F.transform("cells", lambda c: c.cast("string")).alias("cells"))
    return utf8.unionByName(rows.where("encoding <> 'utf-8'").mapInArrow(_decoded, "path string, row_index int, cells array<string>"))
