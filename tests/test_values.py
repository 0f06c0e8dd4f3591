"""Value and name expressions on the micro-fixtures."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import values as V
from keelson.operators import discovery as D

NORMALISED = {
    "1": "1", "1.0": "1", "001": "1", " 1 ": "1", "3.14": "3.14", "nan": None, "NA": None, "NaT": None, "Null": None, "hello": "hello", "": None, "-5": "5", "-1.0": "1",
    "-3.5": "-3.5", "+7": "7", "0": "0", "000": "0", "1e3": "1000", "1234567.5": "1.23457e+06", "0.00001234": "1.234e-05", "999999.7": "1e+06", "0.1": "0.1", "1_000": "1_000",
}


def test_normalise(spark):
    long = "x" * 300
    expected = NORMALISED | {None: None, "1e20": "1e+20", ".5": "0.5", "+.": "+.", "5.": "5", "\x0b7\f": "7", long: "md5:" + hashlib.md5(long.encode()).hexdigest()}
    rows = V.in_one_form(spark.createDataFrame([(k,) for k in expected], "v string"), F.col("v"), "n").collect()
    assert {r.v: r.n for r in rows} == expected


def test_long_texts_differ_by_their_white_space_only_as_cells(spark):
    long = "x" * 300
    cells = spark.createDataFrame([(long,), (f" {long}\n",), (long[:250] + " " * 20,)], "v string").select(V.as_text(F.col("v"), T.StringType()).alias("v"))
    assert cells.distinct().count() == 3
    assert {r.n for r in V.in_one_form(cells, F.col("v"), "n").collect()} == {"md5:" + hashlib.md5(long.encode()).hexdigest(), long[:250]}


def test_generated_methods_are_small(spark):
    """HotSpot compiles methods of up to 8,000 bytes only."""
    rows = spark.range(10).select(F.lit("t").alias("table"), F.lit("c").alias("column"), F.col("id").cast("string").alias("value"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else there is no code before the plan runs
    rows = rows.repartition(2)  # so that nothing is folded into the literals
    codegen = D.normalised(rows)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(-?\d+)", codegen)]
    assert len(sizes) == codegen.count("== Subtree ") > 0 and 0 < min(sizes) and max(sizes) < 8000


@pytest.mark.parametrize(("value", "expected"), [("101|102|103", ["101", "102", "103"]), ("1||2", ["1||2"]), ("a、b", ["a", "b"]), ("1;2", ["1", "2"]), ("|", ["|"]), ("hello", ["hello"])])
def test_parts(spark, value, expected):
    assert spark.range(1).select(V.parts(F.lit(value)).alias("p")).first().p == expected


def test_excel_letters(spark):
    got = {r.id: r.x for r in spark.range(0, 703).select("id", V.excel_letter(F.col("id")).alias("x")).collect()}
    assert [got[i] for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    far = spark.createDataFrame([(16383,), (18277,), (18278,), (None,)], "id long").select(V.excel_letter(F.col("id")).alias("x")).collect()
    assert [r.x for r in far] == ["XFD", "ZZZ", "AAAA", None]


def test_subsequence(spark):
    row = spark.createDataFrame([("skl", "skill"), ("kls", "skill"), ("a.b", "xa.yb"), ("a.b", "axb")], "s string, t string").select(V.is_subsequence(F.col("s"), F.col("t")).alias("x")).collect()
    assert [r.x for r in row] == [True, False, True, False]
