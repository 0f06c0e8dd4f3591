"""Readers of untyped files: listings, CSV, TSV and spreadsheets."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import as_text
from . import delimited, workbook
from .versions import Versions

#: Rows of a sheet that are handed on at a time.
CHUNK_ROWS = 20_000
PATTERN = "*.{csv,tsv,xlsx}"
CELLS = "source string, row_index int, row int, cells array<string>, path string"


def listing(spark: SparkSession, folder: str, pattern: str = PATTERN) -> DataFrame:
    """(path, modified, size) of the files below a folder; hidden and lock files are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    return files.where(~name.rlike(r"^[.~]")).select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def read(spark: SparkSession, where: str | list[str]) -> DataFrame:
    """(source, row_index, row, cells, path) of all CSV, TSV and XLSX files below a folder, or of those named.

    CSV and TSV files are read by blocks of lines (see ``delimited``), workbooks by one task each.
    ``row_index`` counts the rows that there are, from 0; ``row`` is the number of the row in its sheet, from 1, where rows without a cell leave gaps.
    A file that cannot be read has one row: source null, row_index -1, the error in cells.
    A sheet's source is the file's stem, with the sheet's name unless that is Sheet1 or the stem.
    Sheets whose name begins with # are skipped, as are sheets of one column and, in CSV files, blank lines.
    Rows keep their own number of cells.
    """
    rows = delimited.records(spark, where, "*.{csv,tsv,CSV,TSV}")
    wide = rows.groupBy("path").agg(F.max(F.size("cells")).alias("width")).where("width > 1").select("path")
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    texts = rows.join(wide, "path").select(stem.alias("source"), "row_index", (F.col("row_index") + 1).alias("row"), "cells", "path")
    books = where if isinstance(where, str) else [x for x in where if x.lower().endswith(".xlsx")]
    if not books:
        return texts
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{xlsx,XLSX}").load(books)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    books = files.where(~name.rlike(r"^[.~]")).select(F.col("_metadata.file_path").alias("path"), "content").mapInPandas(_rows, CELLS)
    return texts.unionByName(books)


def sheets(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``read`` of all files that can be read."""
    return read(spark, folder).where("source is not null")


def unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """(path, error) of the files that cannot be read."""
    return read(spark, folder).where("source is null").select("path", F.get("cells", F.lit(0)).alias("error"))


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            out: list[pd.DataFrame] = []
            try:
                # A book whose later sheets are broken gives none of them, so a file is either read or an error.
                for source, rows in workbook.sheets(path.rsplit("/", 1)[-1].rpartition(".")[0], io.BytesIO(content)):
                    out += _chunks(source, rows, path)
            except (ValueError, KeyError, IndexError, zipfile.BadZipFile, ElementTree.ParseError) as e:
                out = [pd.DataFrame({"source": [None], "row_index": [-1], "row": [-1], "cells": [[f"{type(e).__name__}: {e}"]], "path": [path]})]
            yield from out


def _chunks(source: str, rows: Iterator[tuple[int, list[str | None]]], path: str) -> list[pd.DataFrame]:
    out, held, wide, at = [], [], False, 0
    for number, cells in rows:
        held.append((number, cells))
        wide = wide or len(cells) > 1
        if len(held) == CHUNK_ROWS:
            out.append(_chunk(source, at, held, path))
            at, held = at + len(held), []
    if held:
        out.append(_chunk(source, at, held, path))
    return out if wide else []


def _chunk(source: str, at: int, rows: list[tuple[int, list[str | None]]], path: str) -> pd.DataFrame:
    return pd.DataFrame({"source": source, "row_index": range(at, at + len(rows)), "row": [n for n, _ in rows], "cells": [c for _, c in rows], "path": path})


def write_sheet(df: DataFrame, path: str) -> None:
    """A table as one CSV file with a row of names; values as texts, as profiles have them.  A file that is there is replaced."""
    store, part = Versions(df.sparkSession, path.rsplit("/", 1)[0]), f"{path.rsplit('/', 1)[0]}/.part-{uuid.uuid4().hex}"
    texts = df.select(*(as_text(F.col(f"`{f.name}`"), f.dataType, whole=True).alias(f.name) for f in df.schema.fields))
    texts.coalesce(1).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(part)
    store.move(store.found(f"{part}/part-*")[0], path)
    store.remove(part)


def table(rows: DataFrame, source: str, offset: int, names: list[str]) -> DataFrame:
    """One source's rows behind its header as a table of text columns."""
    data = rows.where((F.col("source") == source) & (F.col("row_index") >= offset))
    return data.select(*(F.get("cells", F.lit(k)).alias(n) for k, n in enumerate(names)))
