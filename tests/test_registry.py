"""The driver's contract, the graph on disk and the trigger of rebuilds."""

import duckdb
import pytest

import __spark_entry__ as entry
from keelson.plans.catalog import TABLES, Catalog
from keelson.sources import graph_store
from keelson.streaming.incremental import on_change

SMALL = "/root/testdata/sf0.001"
SOME = ("column_stats", "primary_keys", "column_pair_overlap", "containment_relations", "naming_relations", "final_relations", "join_paths", "value_index", "enum_cross_ref", "report_recall", "column_dtypes", "incremental_pairs", "vector_neighbours", "cell_locator", "locate_cell", "relation_evidence", "full_name_lookup", "query_columns", "report_path_search", "report_dag", "feedback_apply", "compound_values", "strict_relations", "enhanced_relations", "header_rows", "abbrev_lookup", "excel_letters", "cn_bridge", "column_index_cn", "communities", "chunks_text", "library_refresh")


@pytest.mark.parametrize("name", SOME)
def test_oracles(spark, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    found = c.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SMALL)
    assert sorted(got.columns) == sorted(found.columns)
    rows = lambda columns, data: sorted(str(sorted(zip(columns, map(str, r)))) for r in data)
    assert rows(got.columns, got.collect()) == rows(found.columns, found.fetchall())


def test_every_table_has_a_digest(spark):
    got = {r.table: r.content_hash for r in entry.queries()["content_hash"](spark, SMALL).collect()}
    assert set(got) == set(TABLES) and len(set(got.values())) == len(TABLES)


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_graph_store(spark, tmp_path):
    graph_store.save(Catalog.of(spark, SMALL), str(tmp_path))
    assert graph_store.load(spark, str(tmp_path), "relations").count() == Catalog.of(spark, SMALL).relations.count()
    with pytest.raises(ValueError):
        graph_store.load(spark, str(tmp_path), "other")


def test_stream_triggers(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    seen = []
    stream = on_change(spark, str(tmp_path / "in"), "id long", seen.append, str(tmp_path / "cp"))
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    assert seen and all(".parquet" in p for paths in seen for p in paths)
