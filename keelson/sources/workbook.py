"""XLSX workbooks: the rows of each sheet with the numbers that the file gives them, read as a stream."""

from __future__ import annotations

import datetime
import re
import zipfile
from collections.abc import Iterator
from typing import IO
from xml.etree import ElementTree

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Numbers of the built-in formats of dates and times.
DATE_FORMATS = frozenset({*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)})


def _each(stream: IO[bytes], tag: str) -> Iterator[ElementTree.Element]:
    """The elements of one kind, each forgotten when the next is asked for."""
    above: list[ElementTree.Element] = []
    for event, element in ElementTree.iterparse(stream, ("start", "end")):
        if event == "start":
            above.append(element)
            continue
        above.pop()
        if element.tag == _M + tag:
            yield element
            if above:
                above[-1].remove(element)


def _is_date(code: str) -> bool:
    """Whether a format code shows a date or a time: outside quotes, brackets and escapes."""
    return bool(re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.|\*.', "", code.lower()).replace("general", "")))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """The numbers of the cell styles that show dates."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dates = {int(f.get("numFmtId")) for f in root.iter(f"{_M}numFmt") if _is_date(f.get("formatCode", ""))} | DATE_FORMATS
    cells = root.find(f"{_M}cellXfs")
    return {k for k, xf in enumerate(cells if cells is not None else ()) if int(xf.get("numFmtId", 0)) in dates}


def as_date(serial: str, since_1904: bool) -> str:
    """A day number as date and time in ISO form; what is no number or no day stays as it is."""
    try:
        days = float(serial)
        if not 0 <= days < 2958466:
            return serial
        # Day 60 of the older calendar is a 29 February 1900 that there never was.
        start = datetime.datetime(1904, 1, 1) if since_1904 else datetime.datetime(1899, 12, 30 if days >= 60 else 31)
        return (start + datetime.timedelta(milliseconds=round(days * 86_400_000))).isoformat()
    except ValueError:
        return serial


def sheets(stem: str, content: IO[bytes]) -> Iterator[tuple[str, Iterator[tuple[int, list[str | None]]]]]:
    """(source, rows) of each sheet but those whose name begins with #; rows are (number in the sheet, cells)."""
    book = zipfile.ZipFile(content)
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        with book.open("xl/sharedStrings.xml") as stream:
            shared = ["".join(t.text or "" for t in item.iter(f"{_M}t")) for item in _each(stream, "si")]
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    properties = root.find(f"{_M}workbookPr")
    since_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    dates = _date_styles(book)
    for sheet in root.findall(f"{_M}sheets/{_M}sheet"):
        name = sheet.get("name", "")
        if name.startswith("#"):
            continue
        target = targets[sheet.get(_REL)].lstrip("/")
        source = stem if name in ("Sheet1", stem) else f"{stem}_{name}"
        yield source, _rows(book, target if target.startswith("xl/") else f"xl/{target}", shared, dates, since_1904)


def _rows(book: zipfile.ZipFile, target: str, shared: list[str], dates: set[int], since_1904: bool) -> Iterator[tuple[int, list[str | None]]]:
    number = 0
    with book.open(target) as stream:
        for row in _each(stream, "row"):
            number = int(row.get("r") or number + 1)
            out: list[str | None] = []
            for cell in row.findall(f"{_M}c"):
                letters = re.match("[A-Z]*", cell.get("r", ""))[0]
                at = sum((ord(c) - 64) * 26**k for k, c in enumerate(reversed(letters))) - 1 if letters else len(out)
                out += [None] * (at - len(out)) + [_value(cell, shared, dates, since_1904)]
            if any(x is not None for x in out):
                yield number, out


def _value(cell: ElementTree.Element, shared: list[str], dates: set[int], since_1904: bool) -> str | None:
    value, kind = cell.find(f"{_M}v"), cell.get("t", "n")
    text = value.text if value is not None else "".join(t.text or "" for t in cell.iter(f"{_M}t")) or None
    if text is None:
        return None
    if kind == "s":
        return shared[int(text)]
    if kind == "b":
        return "True" if text == "1" else "False"
    return as_date(text, since_1904) if kind == "n" and int(cell.get("s", 0)) in dates else text
