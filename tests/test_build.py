"""From files to relations and assets."""

import json
from pathlib import Path

import pytest

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keelson.__main__ import main
from keelson.operators import discovery as D
from keelson.operators.settings import Settings
from keelson.plans.build import ASSETS, SheetCatalog, build
from keelson.sources.versions import Versions


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("sheets")
    (path / "hero.csv").write_text("id,name,,name\nint,string,string,string\n编号,名字,备注,别名\n" + "".join(f"{i},h{i},,n{i % 7}\n" for i in range(1, 101)), "utf-8")
    rows = "".join(f"{i + 500}\t{i % 90 + 1}\ts{i}\n" for i in range(300))
    (path / "skill.tsv").write_text("id\thero_id\tlabel\n" + rows + "900\t5\tlast\tone more\n901\n")
    (path / "bad.xlsx").write_bytes(b"no workbook")
    (path / "more").mkdir()
    (path / "more" / "skill.csv").write_text("a,b\n1,2\n")
    return path


def test_sheet_catalog(spark, folder):
    c = SheetCatalog(spark, str(folder))
    assert {r.table: (r.names, r.header_rows) for r in c.headers.collect()} in (
        {"hero": (["id", "name", "Unnamed: 2", "name.1"], 2), "skill": (["id", "hero_id", "label", "Unnamed: 3"], 0)},
        {"hero": (["id", "name", "Unnamed: 2", "name.1"], 2), "skill": (["a", "b"], 0)},
    )
    assert sorted(r.path.rsplit("/", 1)[-1] for r in c.errors.collect())[0] == "bad.xlsx" and c.errors.count() == 2


def test_build(spark, folder, tmp_path, capsys):
    (folder / "more" / "skill.csv").rename(folder / "more" / "empty.txt")
    out = tmp_path / "out"
    catalog, assets = build(spark, str(folder), str(out))
    assert {r.asset: r.error for r in assets.collect()} == dict.fromkeys(ASSETS)
    stats = {(r.table, r.column): (r.dtype, r.unique_count, r.null_count, r.total_count) for r in catalog.columns.collect()}
    assert stats[("skill", "id")] == ("int", 302, 0, 302) and stats[("skill", "hero_id")] == ("int", 90, 1, 302) and stats[("skill", "Unnamed: 3")] == ("str", 1, 301, 302)
    assert stats[("hero", "id")] == ("int", 100, 0, 100) and ("hero", "Unnamed: 2") not in stats
    assert {(r.from_table, r.from_column, r.to_table, r.to_column) for r in catalog.relations.collect()} == {("skill", "hero_id", "hero", "id")}
    stored = Versions(spark, str(out / "assets")).pointer()
    lines = lambda name: [json.loads(x) for p in Path(stored["parts"][name]).glob("part-*.json") for x in p.read_text("utf-8").splitlines()]
    assert {(x["table"], x["column"]): x["data_start_row"] for x in lines("cell_locator")}[("hero", "id")] == 4
    assert {x["key"]: x["row"] for x in lines("row_locator") if x["table"] == "hero"}["1"] == 4
    assert lines("relation_evidence") == [{"from_table": "skill", "from_column": "hero_id", "to_table": "hero", "to_column": "id", "shared": 90, "examples": "1,10,11,12,13"}]
    assert {x["kind"] for x in lines("analysis")} == {"centrality", "module", "critical_path"}
    assert "Longest chain: 1" in {x["text"] for x in lines("analysis_summary")} and "Cycles: 0" in {x["text"] for x in lines("analysis_summary")}
    main(["query", str(out), "skill"])
    assert "skill.hero_id = hero.id" in capsys.readouterr().out


def test_settings(spark, tmp_path):
    file = tmp_path / "settings"
    file.write_text("# thresholds\n\ncontainment: 0.95\nper_pair: 1\n")
    got = Settings.read(spark, str(file))
    assert (got.containment, got.per_pair, got.final) == (0.95, 1, 0.5)
    for wrong in ("containmnt: 0.9", "per_pair: 1\nper_pair: 2", "final: much", "final"):
        file.write_text(wrong)
        with pytest.raises(ValueError):
            Settings.read(spark, str(file))


def test_settings_act(spark, folder):
    found = lambda **by: {r.from_column for r in SheetCatalog(spark, str(folder), settings=Settings(**by)).containment.collect()}
    assert found() == {"hero_id"}
    assert found(min_shared=91, min_shared_id=91) == found(weak=1.5) == set()


def test_a_strategy_that_fails(spark, folder, tmp_path, monkeypatch):
    def broken(*_):
        return spark.range(1).select(F.raise_error(F.lit("broken")).alias("from_table"))

    monkeypatch.setattr(D, "containment", broken)
    catalog, done = build(spark, str(folder), str(tmp_path / "out"))
    assert {r.asset for r in done.where("error is not null").collect()} == {"strategy: containment"} and "broken" in catalog.failures["containment"]
    assert {(r.from_column, r.discovery_method) for r in catalog.relations.collect()} == {("hero_id", "naming_convention")}
    with pytest.raises(PySparkException):
        SheetCatalog(spark, str(folder)).containment
