"""Files of several formats and encodings."""

import csv
import io
import random
import zipfile
from urllib.parse import unquote

import pandas as pd
import pytest
from pyspark.sql import functions as F

from keelson.plans.build import SheetCatalog
from keelson.sources import delimited, files
from keelson.sources import workbook as books
from keelson.sources.versions import Versions


def test_sheets(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,名称\n1,x\n".encode("gbk"))
    (tmp_path / "b.tsv").write_text("id\tname\n1\ty, z\n")
    (tmp_path / "~lock.csv").write_text("a,b\n")
    (tmp_path / "bad.xlsx").write_bytes(b"no workbook")
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(tmp_path / "c.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="Sheet1" r:id="r1"/><sheet name="#skip" r:id="r1"/><sheet name="more" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>key</t></si></sst>")
        z.writestr("xl/worksheets/s.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>2.5</v></c></row></sheetData></worksheet>')
    got = {(r.source, r.row_index): r.cells for r in files.sheets(spark, str(tmp_path)).collect()}
    assert got == {
        ("a", 0): ["id", "名称"], ("a", 1): ["1", "x"], ("b", 0): ["id", "name"], ("b", 1): ["1", "y, z"], ("c", 0): ["key", None, "2.5"], ("c_more", 0): ["key", None, "2.5"],
    }
    assert [r.path.rsplit("/", 1)[-1] for r in files.unreadable(spark, str(tmp_path)).collect()] == ["bad.xlsx"]
    assert {r.path.rsplit("/", 1)[-1] for r in files.listing(spark, str(tmp_path)).collect()} == {"a.csv", "b.tsv", "bad.xlsx", "c.xlsx"}
    assert [tuple(r) for r in files.table(files.sheets(spark, str(tmp_path)), "a", 1, ["id", "name"]).collect()] == [("1", "x")]


NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def workbook(rows, styles="", properties=""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS}>{properties}<sheets><sheet name="Sheet1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {NS}>{styles}</styleSheet>")
        z.writestr("xl/worksheets/s.xml", f"<worksheet {NS}><sheetData>{rows}</sheetData></worksheet>")
    return out.getvalue()


def test_sheets_are_whole():
    """A sheet of very many rows keeps all of them, in order."""
    rows = "".join(f'<row><c r="A{k}"><v>{k}</v></c><c r="B{k}"><v>x</v></c></row>' for k in range(1, 50_003))
    got = pd.concat(files._rows(iter([pd.DataFrame({"path": ["/x/a.xlsx"], "content": [workbook(rows)]})])))
    assert got["row_index"].tolist() == list(range(50_002)) and got["cells"].tolist()[-1] == ["50002", "x"]


def test_rows_and_dates_of_a_workbook(spark, tmp_path):
    """Rows keep the numbers of the file, cells with a format of dates are dates."""
    styles = '<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm"/><numFmt numFmtId="165" formatCode="0&quot;d&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'
    row = lambda n, *cells: f'<row r="{n}">' + "".join(f'<c r="{"ABCD"[k]}{n}" {a}><v>{v}</v></c>' for k, (a, v) in enumerate(cells)) + "</row>"
    head = row(2, ('t="str"', "id"), ('t="str"', "day"), ('t="str"', "size"), ('t="str"', "flag"))
    data = [row(n, ("", n), (f's="{1 + n % 2}"', 45000.5), ('s="3"', 7), ('t="b"', n % 2)) for n in (3, 7, 8, 12)]
    (tmp_path / "gaps.xlsx").write_bytes(workbook(head + '<row r="5"/>' + "".join(data), styles))
    c = SheetCatalog(spark, str(tmp_path))
    assert {r.row: r.cells for r in c.data.collect()} == {n: [str(n), "2023-03-15T12:00:00", "7", str(bool(n % 2))] for n in (3, 7, 8, 12)}
    assert [tuple(r) for r in c.rows_by_key.orderBy("row").collect()] == [("gaps", str(n), n) for n in (3, 7, 8, 12)]
    assert {r.data_start_row for r in c.starts.collect()} == {3}


def test_days():
    assert [books.as_date(x, False) for x in ("1", "59", "61", "45000.25", "-1", "x")] == ["1900-01-01T00:00:00", "1900-02-28T00:00:00", "1900-03-01T00:00:00", "2023-03-15T06:00:00", "-1", "x"]
    assert books.as_date("0", True) == "1904-01-01T00:00:00"
    assert [books._is_date(x) for x in ("yyyy", "[$-409]h:mm", '0"days"', "General", "0.00", "[Red]0")] == [True, True, False, False, False, False]


@pytest.mark.parametrize("size", [150, 997, 1 << 20])
def test_blocks_of_a_file(spark, tmp_path, size):
    """However a file is cut, its records are those that one reader finds, with line feeds and separators in quotes across the cuts."""
    r = random.Random(size)
    part = lambda: r.choice(["x", "", "é中", 'say ""hi""', "a,b", "one\ntwo", "three\r\n\n\nfour", "l\n" * 30])
    lines = [",".join(f'"{part()}"' if r.random() < 0.5 else r.choice(["1", 'in"ner', "", " z"]) for _ in range(r.randint(1, 4))) for _ in range(60)]
    text = "\ufeff" + "".join(x + r.choice(["\n", "\r\n", "\n\n"]) for x in lines) + 'open,"end'
    (tmp_path / "a b.csv").write_bytes(text.encode())
    (tmp_path / "名.csv").write_bytes("编号,\"名\n称\"\n1,乙\n".encode("gbk") * 20)
    (tmp_path / "mac.csv").write_bytes('a,b\r1,"x\ry"\r2,"p\nq"\r\r3,z\r'.encode("latin-1") + b"\xe9\x80,\xff\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = {}
        for x in delimited.records(spark, str(tmp_path), "*.csv").collect():
            got.setdefault(unquote(x.path.rsplit("/", 1)[-1]), {})[x.row_index] = x.cells
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for path in tmp_path.iterdir():
        content = path.read_bytes()
        encoding = {"名.csv": "gbk", "mac.csv": "latin-1"}.get(path.name, "utf-8-sig")
        want = [x for x in csv.reader(io.StringIO(content.decode(encoding), newline="")) if x]
        assert got[path.name] == dict(enumerate(want)), path.name


def test_versions(spark, tmp_path):
    """A version counts when its pointer is there: a writer that fails leaves the one before; two writers do not mix."""
    store = Versions(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError):
        store.read("a")
    first = store.begin()
    first.put("a", spark.range(1))
    first.put("b", spark.range(2))
    assert store.pointer()["parts"] == {} and first.commit({"x": 1}) == 1
    broken = store.begin()
    broken.put("a", spark.range(10))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        broken.put("b", spark.range(5).select((F.lit(1) / F.lit(0)).alias("id")))
    assert store.read("a").count() == 1 and store.read("b").count() == 2 and store.pointer()["more"] == {"x": 1}
    one, other = store.begin(), store.begin()
    one.put("a", spark.range(3))
    other.put("a", spark.range(4))
    assert one.commit() == 2
    with pytest.raises(Exception, match="(?i)exist"):
        other.commit()
    assert store.read("a").count() == 3 and store.read("b").count() == 2
    store.prune(1)
    assert store.read("a").count() == 3 and store.read("b").count() == 2 and len(list((tmp_path / "store" / "data").iterdir())) == 2
