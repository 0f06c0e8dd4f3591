"""Profiles and relations of small tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.functions.vocabulary import TYPE_WORDS
from keelson.operators import assets as A, bridge, discovery as D, graph as G, profile as P, retrieval as R
from keelson.plans.catalog import Catalog
from keelson.sources import feedback
from keelson.streaming.incremental import file_changes, refreshed

EDGE = "from_table string, from_column string, to_table string, to_column string, relation_type string, confidence double, discovery_method string, evidence string"


@pytest.fixture(scope="module")
def catalog(spark):
    hero = spark.createDataFrame([(i, f"h{i}") for i in range(1, 101)], "id int, name string")
    skill = spark.createDataFrame([(i + 500, i % 90 + 1, f"s{i}") for i in range(300)], "id int, hero_id int, label string")
    return Catalog(spark, {"hero": hero, "skill": skill})


def edges(spark, *rows):
    return spark.createDataFrame([(a, b, c, d, "x", conf, m, "e") for a, b, c, d, conf, m in rows], EDGE)


def keys(df):
    return {(r.from_table, r.from_column, r.to_table, r.to_column): r.confidence for r in df.collect()}


def test_relations(spark, catalog):
    assert {r.table: r.primary_key for r in catalog.tables.collect()} == {"hero": "id", "skill": "id"}
    assert keys(catalog.naming) == {("skill", "hero_id", "hero", "id"): 0.95}
    assert keys(catalog.relations)[("skill", "hero_id", "hero", "id")] == 0.98


def test_incremental_equals_full(spark, catalog):
    known = catalog.containment.unionByName(catalog.naming)
    again = refreshed(known, catalog.columns, catalog.tables, catalog.norm, catalog.candidates, ("skill",))
    assert keys(D.final(again)) == keys(D.final(known))


def test_types_from_all_values(spark):
    """Digits sort before letters: the smallest values do not speak for a column."""
    rows = [(str(k), str(k) if k < 85 else f"w{k}") for k in range(100)] + [(f"word{k}", None) for k in range(5000)]
    c = Catalog(spark, {"t": spark.createDataFrame(rows, "a string, b string")})
    assert {r.column: r.dtype for r in c.columns.collect()} == {"a": "str", "b": "float"}


def test_naming_of_chinese_columns(spark):
    """A column with a Chinese name refers to the table of the entity nearest to its end."""
    hero = spark.createDataFrame([(i, f"h{i}") for i in range(1, 40)], "id int, name string")
    skill = spark.createDataFrame([(i, f"s{i}") for i in range(500, 540)], "id int, name string")
    fight = spark.createDataFrame([(i, 500 + i % 40, f"f{i}") for i in range(9000, 9100)], "id int, `英雄主动技能ID` int, label string")
    assert ("fight", "英雄主动技能ID", "skill", "id") in keys(Catalog(spark, {"hero": hero, "skill": skill, "fight": fight}).naming)


def test_vector_neighbours(spark, monkeypatch):
    """Blocks give what one comparison of all gives; odd vectors are not compared."""
    monkeypatch.setattr(R, "VECTOR_ROWS", 30)
    monkeypatch.setattr(R, "VECTOR_QUERIES", 1)
    r = random.Random(5)
    rows = [(k, [r.choice([-1.0, 0.5, 2.0]) for _ in range(4)]) for k in range(301)] + [(400, [0.0] * 4), (401, None), (402, [1.0, 2.0]), (500, [3.0, 4.0])]
    got = {}
    for x in R.vector_neighbours(spark.createDataFrame(rows, "id long, v array<float>"), "id", "v", 5).collect():
        got.setdefault(x.query, []).append((-x.similarity, x.id))
    want = {}
    for q, a in rows:
        if q % 100 or not a or not any(a):
            continue
        norm = lambda v: math.sqrt(sum(x * x for x in v))
        every = [(-math.floor(sum(x * y for x, y in zip(a, b)) / (norm(a) * norm(b)) * 1e6 + 0.5) / 1e6, i) for i, b in rows if b and any(b) and len(a) == len(b)]
        want[q] = sorted(every)[:5]
    assert {q: sorted(x) for q, x in got.items()} == want


def test_locators(spark):
    """Rows are found by their place in the sheet, data by the header's."""
    sheet = spark.createDataFrame([("b", 4), ("a", 5), ("c", 6)], "id string, place long")
    assert {(r.key, r.row) for r in A.row_locator(sheet, "t", "id", row="place").collect()} == {("b", 4), ("a", 5), ("c", 6)}
    columns = spark.createDataFrame([("t", "id", 0), ("u", "id", 27)], "table string, column string, ordinal int")
    starts = spark.createDataFrame([("t", 4)], "table string, data_start_row long")
    assert {(r.table, r.letter, r.data_start_row) for r in A.cell_locator(columns, starts).collect()} == {("t", "A", 4), ("u", "AB", 2)}


def test_fusion_and_pruning(spark):
    rel = edges(spark, ("a", "x", "b", "y", 0.95, "naming_convention"), ("b", "y", "a", "x", 0.90, "containment"), ("a", "u", "b", "v", 0.9, "containment"), ("a", "p", "b", "q", 0.85, "containment"))
    assert keys(D.fused(rel))[("a", "x", "b", "y")] == 0.98
    assert set(keys(D.final(rel))) == {("a", "x", "b", "y"), ("a", "u", "b", "v")}
    low = edges(spark, ("a", "x", "b", "y", 0.5, "naming_convention"), ("a", "u", "b", "v", 0.9, "containment"), ("a", "p", "b", "q", 0.9, "containment"))
    assert ("a", "x", "b", "y") in keys(D.deduplicated(low)) and len(keys(D.deduplicated(low))) == 2


def test_feedback(spark):
    rel = edges(spark, ("a", "x", "b", "y", 0.6, "containment"), ("c", "x", "b", "y", 0.6, "containment"), ("d", "x", "b", "y", 0.6, "containment"), ("e", "x", "b", "y", 0.6, "containment"))
    said = spark.createDataFrame([("b.y->a.x", "rejected"), ("c.x->b.y", "confirmed"), ("b.y->d.x", "confirmed")], "relation_key string, status string")
    assert keys(D.with_feedback(rel, said)) == {("c", "x", "b", "y"): 1.0, ("d", "x", "b", "y"): 1.0, ("e", "x", "b", "y"): 0.6}


def test_feedback_store(spark, tmp_path):
    """The last word on a relation counts."""
    rel = edges(spark, ("a", "x", "b", "y", 0.6, "c"), ("c", "x", "b", "y", 0.6, "c"), ("d", "x", "b", "y", 0.6, "c"))
    path = str(tmp_path / "said")
    feedback.say(rel.where("from_table <> 'd'"), "confirmed", path, 1.0)
    feedback.say(rel.where("from_table = 'c'"), "rejected", path, 2.0)
    assert {r.from_table: r.status for r in feedback.check(rel, feedback.said(spark, path)).collect()} == {"a": "confirmed", "c": "rejected", "d": "unknown"}
    assert {k[0]: v for k, v in keys(D.with_feedback(rel, feedback.said(spark, path))).items()} == {"a": 1.0, "d": 0.6}
    with pytest.raises(ValueError):
        feedback.say(rel, "maybe", path)


def test_acyclic(spark):
    """Of two tables one relation stays; b>c goes from a>b>c>a, and d>a, behind c>d by name, from a>b>c>d>a."""
    rel = edges(spark, ("a", "x", "b", "y", 0.9, "c"), ("b", "x", "a", "y", 0.8, "c"), ("b", "x", "c", "y", 0.7, "c"), ("c", "x", "a", "y", 0.8, "c"), ("c", "x", "d", "y", 0.6, "c"), ("d", "x", "a", "y", 0.6, "c"), ("e", "x", "a", "y", 0.4, "c"))
    assert {(r.from_table, r.to_table): r.confidence for r in G.acyclic(rel).collect()} == {("a", "b"): 0.9, ("c", "a"): 0.8, ("c", "d"): 0.6}
    assert G.acyclic(rel.limit(0)).count() == 0


def test_paths_between_words(spark):
    rel = edges(spark, ("hero_a", "x", "mid", "y", 0.9, "c"), ("mid", "x", "item_a", "y", 0.9, "c"), ("item_a", "x", "item_b", "y", 0.9, "c"))
    assert {(r.src, r.dst, r.hops) for r in G.paths(rel, 3, 0.0, ends=("hero", "item")).collect()} == {("hero_a", "item_a", 2)}
    assert {(r.src, r.dst, r.hops) for r in G.paths(rel, 3, 0.0, ends=("hero", "item_b")).collect()} == {("hero_a", "item_b", 3)}


def test_abbreviated_with_hits(spark):
    """A mined abbreviation finds a relation where values fit, an enumeration its like in another table."""
    hero = spark.createDataFrame([(i, f"h{i}", "abc"[i % 3]) for i in range(1, 301)], "id int, name string, camp string")
    log = spark.createDataFrame([(i + 9000, i % 40 + 1, "abc"[i % 3]) for i in range(300)], "id int, hr int, camp string")
    other = spark.createDataFrame([(i + 5000, i % 40 + 1) for i in range(300)], "id int, hr_id int")
    c = Catalog(spark, {"hero": hero, "fight": log, "other": other})
    known = edges(spark, ("other", "hr_id", "hero", "id", 0.9, "containment"))
    assert ("fight", "hr", "hero", "id") in keys(D.abbreviated(c.columns, c.tables, c.norm, known))
    assert [(r.column, r.tables, r.shared, r.shared_values) for r in A.enum_cross_ref(c.cells, c.columns).collect()] == [("camp", "fight,hero", 3, "a,b,c")]


def test_transitive(spark):
    rel = edges(spark, ("a", "x", "b", "y", 0.9, "containment"), ("b", "z", "c", "w", 0.9, "containment"))
    assert keys(D.transitive(rel)) == {("a", "x", "c", "w"): 0.41}
    assert keys(D.transitive(rel.union(edges(spark, ("c", "w", "a", "x", 0.4, "containment"))))) == {}


def test_graph(spark):
    rel = edges(spark, ("a", "x", "b", "y", 0.9, "c"), ("b", "x", "c", "y", 0.9, "c"), ("c", "x", "a", "y", 0.9, "c"), ("d", "x", "e", "y", 0.7, "c"), ("e", "x", "f", "y", 0.8, "c"))
    nodes = spark.createDataFrame([(n,) for n in "abcdefg"], "table string")
    assert [tuple(r) for r in G.cycles(rel).collect()] == [("a>b>c", 3)]
    assert [r.table for r in G.orphans(nodes, rel).collect()] == ["g"]
    assert tuple(G.critical_path(rel).first()) == ("d>e>f", 2)
    assert {(r.src, r.dst): r.hops for r in G.paths(rel, 2, 0.65).collect()}[("d", "f")] == 2
    assert {r.table: r.community for r in G.communities(nodes, rel).collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "f": "d"}
    star = edges(spark, *((x, "k", "m", "id", 0.9, "c") for x in "abcd"))
    assert {r.table: r.score for r in G.centrality(spark.createDataFrame([(n,) for n in "abcdm"], "table string"), star, rounds=20).collect()}["m"] == 100.0


def test_long_cycles_and_chains(spark):
    """Cycles of more than four tables, chains of more than 14."""
    ring = [(f"r{k}", "x", f"r{(k + 1) % 6}", "y", 0.9, "c") for k in range(6)]
    rest = [("r5", "x", "s", "y", 0.9, "c"), ("p", "x", "q", "y", 0.9, "c"), ("q", "x", "p", "y", 0.9, "c"), ("q", "x", "r0", "y", 0.9, "c")]
    assert {tuple(r) for r in G.cycles(edges(spark, *ring, *rest)).collect()} == {("r0>r1>r2>r3>r4>r5", 6), ("p>q", 2)}
    chain = [(f"t{k:02}", "x", f"t{k + 1:02}", "y", 0.9, "c") for k in range(18)]
    assert tuple(G.critical_path(edges(spark, *chain, *ring)).first()) == (">".join(f"t{k:02}" for k in range(19)), 18)


SHEETS = (
    ("a", 0, ["id", "name"]), ("a", 1, ["int", "string"]), ("a", 2, ["1", "x y"]), ("b", 0, ["int", "string"]), ("b", 1, ["key of it", "what it is"]),
    ("b", 2, ["", None]), ("b", 3, ["7", "8"]), ("c", 0, ["1", "2"]), ("d", 0, ["alpha", "beta"]), ("d", 1, ["gamma", "delta"]), ("d", 2, ["5", "x"]),
)


def test_header_rows(spark):
    rows = spark.createDataFrame(list(SHEETS), "source string, row_index int, cells array<string>")
    assert {r.source: r.header_rows for r in P.header_rows(rows, TYPE_WORDS).collect()} == {"a": 2, "b": 3, "c": 0, "d": 2}


def test_chinese_names(spark):
    columns = spark.createDataFrame([("英雄主动技能ID",), ("名称",)], "column string")
    tables = spark.createDataFrame([("hero",), ("skill",)], "table string")
    assert [tuple(r) for r in bridge.bridged(columns, tables).collect()] == [("英雄主动技能ID", "skill")]


def test_hot_values_do_not_count_for_the_gate(spark, monkeypatch):
    monkeypatch.setattr(D, "HOT_COLUMNS", 2)
    norm = spark.createDataFrame([(t, "k", v) for t in "abc" for v in ("1", "2")] + [("a", "k", "3"), ("b", "k", "3")], "table string, column string, value string")
    found = {(r.table_a, r.table_b): (r.shared, r.gated) for r in D.overlaps(norm, norm.select("table", "column").distinct()).collect()}
    assert found == {("a", "b"): (3, 1)}  # pairs that share hot values only cannot pass the gate


def test_file_changes(spark):
    at = lambda *rows: spark.createDataFrame(list(rows), "path string, s double").select("path", F.col("s").cast("timestamp").alias("modified"))
    got = {r.path: r.change for r in file_changes(at(("a", 1.0), ("b", 1.0), ("c", 1.0)), at(("a", 1.5), ("b", 9.0), ("d", 1.0))).collect()}
    assert got == {"a": "unchanged", "b": "updated", "c": "deleted", "d": "new"}


def test_values_of_very_many_columns(spark):
    """A value in 5,000 columns is counted for the pairs that pass without it, and makes no pairs of its own."""
    wide = spark.range(5000).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("table"), F.lit("x_id").alias("column"), F.explode(F.array(F.lit("0"), F.lit("1"), F.concat(F.lit("own"), "id"))).alias("value"))
    more = spark.createDataFrame([(t, "y_id", v) for t in ("p", "q") for v in ("0", "1", "7", "8", "9")] + [("p", "y_id", "z")], "table string, column string, value string")
    norm = wide.unionByName(more)
    got = [tuple(r) for r in D.overlaps(norm, norm.select("table", "column").distinct()).collect()]
    assert got == [("p", "y_id", "q", "y_id", 5, 3)]


def test_hot_values_in_parts(spark, monkeypatch):
    """Counted part by part, what is shared equals a plain count."""
    monkeypatch.setattr(D, "HOT_COLUMNS", 4)
    monkeypatch.setattr(D, "HOT_PART", 3)
    r = random.Random(2)
    rows = {(f"t{k % 7}", f"c{k}", str(v)) for k in range(14) for v in r.sample(range(60), 30)}
    norm = spark.createDataFrame(sorted(rows), "table string, column string, value string")
    of, times = {}, {}
    for t, c, v in rows:
        of.setdefault((t, c), set()).add(v)
        times[v] = times.get(v, 0) + 1
    want = {(*a, *b): (len(of[a] & of[b]), sum(times[v] <= 4 for v in of[a] & of[b])) for a in of for b in of if a < b and a[0] != b[0]}
    got = {tuple(x)[:4]: tuple(x)[4:] for x in D.overlaps(norm, norm.select("table", "column").distinct()).collect()}
    assert got == {k: v for k, v in want.items() if v[1]} and got


def test_known_pairs_are_not_counted(spark, catalog):
    known = catalog.overlaps.limit(1)
    assert D.overlaps(catalog.norm, catalog.candidates, known=known).count() == catalog.overlaps.count() - 1
    assert D.overlaps(catalog.norm, catalog.candidates, known=catalog.overlaps).count() == 0


def test_long_lists_are_taken_apart(spark):
    """Cells of over 256 characters are split before they are cut to a digest."""
    ids = "|".join(str(100000 + k) for k in range(90))
    c = Catalog(spark, {"t": spark.createDataFrame([(1, ids), (2, "100001|5"), (3, " " + ids)], "id int, item_ids string")})
    assert {r.value for r in c.norm.where("column = 'item_ids'").collect()} == {*ids.split("|"), "5"}


def test_inverted_file(spark):
    """Of gathered vectors a few lists hold nearly all neighbours; what is found has exact similarities; every vector is in a list."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    rows = [(k, [float(x) for x in centres[k % 20] + rng.normal(size=16) * 0.3]) for k in range(3000)] + [(3000, [1.0, 2.0]), (3100, [2.0, 4.1]), (3200, None), (3300, [0.0] * 16)]
    vectors = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    index = R.VectorIndex(vectors, "id", "v")
    exact = {(r.query, r.id): r.similarity for r in R.vector_neighbours(vectors, "id", "v", 10).collect()}
    found = {(r.query, r.id): r.similarity for r in index.nearest().collect()}
    assert index.rows.count() == 3002 and index.probes < len(index.centroids) // 2
    assert len(found.keys() & exact.keys()) >= 0.9 * len(exact) and all(exact[x] == found[x] for x in found.keys() & exact.keys())
    assert found[(3000, 3100)] == exact[(3000, 3100)]
    none = R.VectorIndex(vectors.where("id < 0"), "id", "v")
    assert none.nearest().count() == 0


def test_words_and_what_they_are_called(spark):
    texts = spark.createDataFrame([("a", "Hot hot GEAR, mail_box"), ("a", "gear source"), ("b", None), ("b", "")], "source string, text string")
    words = D.words(texts)
    assert {tuple(r) for r in words.collect()} == {("a", "hot", 1), ("a", "gear", 2), ("a", "mail_box", 1), ("a", "source", 1)}
    assert {(r.word, r.full_name) for r in D.abbreviations_among(words).collect()} == {("hot", "heal_over_time")}
    assert {(r.word, r.abbreviations) for r in D.full_names_among(words).collect()} == {("source", "src")}
    named = bridge.chinese_names(words, "编号")
    assert {(r.word, r.column) for r in named.collect()} == {("gear", "装备编号")}


def test_tables_of_entities(spark):
    tables = spark.createDataFrame([(t,) for t in ("mail", "mail_base", "Mail_box_x", "mailing", "item_data", "res_a_b")], "table string")
    got = {(r.entity, r.table, r["rank"].how) for r in bridge.entity_tables(tables).collect()}
    assert got == {("邮件", "mail", 0), ("邮件", "mail_base", 1), ("邮件", "Mail_box_x", 2), ("物品", "item_data", 1), ("道具", "item_data", 1), ("资源", "res_a_b", 2)}
