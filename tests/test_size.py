"""Work that must not gather in one task: what is shuffled by column holds no values, and blocks hold few similarities."""

import tracemalloc

import numpy as np
import pyarrow as pa

from keelson.operators import discovery as D
from keelson.operators import profile as P
from keelson.operators import retrieval as R


def shuffles(df):
    """(partitioning, columns) of each shuffle of a plan."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, out = [plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan], []
    while todo:
        p = todo.pop()
        if p.nodeName() == "Exchange":
            out.append((p.outputPartitioning().toString(), p.output().mkString(",")))
        todo += [p.children().apply(k) for k in range(p.children().size())]
    return out


def by_column_only(df):
    return [x for x in shuffles(df) if "value#" in x[1] and "value#" not in x[0]]


def test_types_count_values_before_they_are_shuffled_by_column(spark):
    rows = [("t", "k", str(i), 1) for i in range(9)] + [("t", "f", "1.0", 2), ("t", "f", "2.5", 1), ("t", "w", "3", 1), ("t", "s", "7", 1), ("t", "s", "x", 1), ("t", "n", "4", 2), ("t", "k", None, 1)]
    kinds = [("t", "k", "int"), ("t", "f", "float"), ("t", "w", "float"), ("t", "s", "str"), ("t", "n", "str"), ("t", "empty", "float"), ("t", "none", "str")]
    got = P.types(spark.createDataFrame(rows, "table string, column string, value string, n bigint"), spark.createDataFrame(kinds, "table string, column string, kind string"))
    assert not by_column_only(got)
    assert {r.column: r.dtype for r in got.collect()} == {"k": "int", "f": "float", "w": "int", "s": "str", "n": "int", "empty": "float", "none": "str"}


def test_cells_are_counted_without_names(spark):
    got = P.cells({"t": spark.createDataFrame([(1, "x"), (1, None)], "a int, b string"), "u": spark.createDataFrame([("y",)], "b string")})
    assert not [x for x in shuffles(got) if "column#" in x[1] or "table#" in x[1]]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("t", 0, "a", "1", 2), ("t", 1, "b", "x", 1), ("t", 1, "b", None, 1), ("u", 0, "b", "y", 1)]))


NORM = [("o", "k", v) for v in "abcd"] + [("p", "k", v) for v in "abxy"] + [("q", "k", v) for v in "zw"]


def test_edges_go_to_the_values(spark):
    norm = spark.createDataFrame(NORM, "table string, column string, value string")
    edges = spark.createDataFrame([("o", "k", "p", "k"), ("q", "k", "p", "k"), ("o", "k", "none", "k")], "table string, column string, to_table string, to_column string")
    got = D.containments(edges, norm)
    assert not by_column_only(got)
    assert {(r.table, r.to_table, r.containment) for r in got.collect()} == {("o", "p", 0.5), ("q", "p", 0.0)}


def test_evidence_goes_to_the_values(spark, monkeypatch):
    kept, stored = {}, D.stored
    monkeypatch.setattr(D, "stored", lambda df, name="part": kept.setdefault(name, df) is None or stored(df, name))
    norm = spark.createDataFrame(NORM, "table string, column string, value string")
    ends = spark.createDataFrame([("o", "k", "p", "k")], "from_table string, from_column string, to_table string, to_column string")
    got = D.shared_values(ends, norm)
    assert not by_column_only(kept["evidence"])
    assert [tuple(r) for r in got.collect()] == [("o", "k", "p", "k", 2, "a,b")]


def test_blocks_of_vectors_hold_few_similarities():
    rng = np.random.default_rng(1)
    vectors, ids = rng.normal(size=(20_000, 8)), np.arange(20_000)
    block = lambda at: pa.table({"id": ids[at], "v": pa.array(list(vectors[at]), pa.list_(pa.float64()))})
    rows, queries = block(ids), block(ids[::20])
    tracemalloc.start()
    got = R._nearest(3)(None, rows, queries)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # all similarities of the block are 160 MB
    unit = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
    for q in (0, 1000, 19_980):
        assert [i for x, i in zip(got.column("query").to_pylist(), got.column("id").to_pylist()) if x == q] == np.argsort(-(unit[q] @ unit.T), kind="stable")[:3].tolist()
