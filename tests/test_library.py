"""A folder kept up to date equals one that is read anew."""

import os
import time

import pytest
from pyspark.sql import functions as F

from keelson.operators import discovery as D
from keelson.plans import library
from keelson.plans.build import ASSETS, SheetCatalog
from keelson.plans.library import Library
from keelson.sources import files
from keelson.streaming.incremental import keep_fresh

GLOBAL = ("relation_graph", "value_index", "column_index", "cell_locator", "row_locator", "table_description", "relation_evidence", "report_nodes")


def rows(df):
    return sorted(str(sorted(r.asDict(True).items())) for r in df.collect())


def same_as_a_full_build(spark, lib, folder, all_of_it=False):
    full, now = SheetCatalog(spark, str(folder)), lib.catalog
    assert rows(now.relations) == rows(full.relations)
    if not all_of_it:
        return now
    assert rows(now.overlaps) == rows(full.overlaps) and rows(now.containment) == rows(full.containment) and rows(now.naming) == rows(full.naming)
    assert rows(now.errors) == rows(full.errors)
    for name in GLOBAL:
        assert rows(ASSETS[name](now)) == rows(ASSETS[name](full)), name
    return now


def write(path, text, when):
    path.write_text(text, "utf-8")
    os.utime(path, (when, when))


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "sheets"
    (path / "sub").mkdir(parents=True)
    write(path / "hero.csv", "id,name,skill_ids\n" + "".join(f"{i},h{i},{i % 30 + 500}|{i % 7 + 500}\n" for i in range(1, 61)), 1000)
    write(path / "skill.csv", "id,hero_id,kind\n" + "".join(f"{i + 500},{i % 50 + 1},k{i % 3}\n" for i in range(150)), 1000)
    write(path / "item.tsv", "id\tskill_id\n" + "".join(f"{i + 9000}\t{i % 100 + 500}\n" for i in range(210)), 1000)
    write(path / "bad.xlsx", "no book", 1000)
    return path


def test_changes(spark, folder, tmp_path, monkeypatch):
    read, compared = [], []
    given = files.read

    def noted(s, where):
        if isinstance(where, list):
            read.append(sorted(x.rsplit("/", 1)[-1] for x in where))
        return given(s, where)

    monkeypatch.setattr(files, "read", noted)
    scored = D.scores
    monkeypatch.setattr(D, "scores", lambda pairs, *more: compared.append(pairs) or scored(pairs, *more))
    lib = Library(spark, str(folder), str(tmp_path / "store"))
    assert {r.change for r in lib.refresh().collect()} == {"new"}
    assert lib.catalog.relations.count() and read == [["bad.xlsx", "hero.csv", "item.tsv", "skill.csv"]]
    number = lib.store.pointer()["number"]
    assert {r.change for r in lib.refresh().collect()} == {"unchanged"} and lib.store.pointer()["number"] == number and len(read) == 1

    # one changed, one new, one gone, one of a name that is there already
    write(folder / "skill.csv", "id,hero_id,kind\n" + "".join(f"{i + 500},{i % 55 + 1},k{i % 3}\n" for i in range(150)), 2000)
    write(folder / "sub" / "drop.csv", "id,hero_id\n" + "".join(f"{i + 70000},{i % 40 + 1}\n" for i in range(80)), 2000)
    write(folder / "sub" / "hero.csv", "id,name\n" + "".join(f"{i},x{i}\n" for i in range(1, 41)), 2000)
    (folder / "item.tsv").unlink()
    compared.clear()
    assert {(r.path.rsplit("/", 1)[-1], r.change) for r in lib.refresh().where("change <> 'unchanged'").collect()} == {("skill.csv", "updated"), ("drop.csv", "new"), ("hero.csv", "new"), ("item.tsv", "deleted")}
    assert read[-1] == ["drop.csv", "hero.csv", "skill.csv"]
    again = {tuple(r) for r in compared[0].select("table_a", "column_a", "table_b", "column_b").collect()}
    assert all({"skill", "drop"} & {a, b} for a, _, b, _ in again) and not any({("skill", "id"), ("hero", "skill_ids")} == {(a, c), (b, d)} for a, c, b, d in again)
    now = same_as_a_full_build(spark, lib, folder, True)
    assert {r.table for r in now.tables.collect()} == {"hero", "skill", "drop"} and now.containment.count() and now.naming.count()

    # the first of two files of one name goes, so the other is the table: it was read before
    (folder / "hero.csv").unlink()
    lib.refresh()
    assert len(read) == 2 and lib.catalog.tables.where("table = 'hero'").first().row_count == 40
    same_as_a_full_build(spark, lib, folder)


def test_failed_refresh_and_merging(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(library, "MERGED", 1)
    lib = Library(spark, str(folder), str(tmp_path / "store"))
    lib.refresh()
    before = rows(lib.catalog.relations)
    write(folder / "hero.csv", "id,name\n" + "".join(f"{i},h{i}\n" for i in range(1, 31)), 3000)
    monkeypatch.setattr(Library, "_name", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        lib.refresh()
    assert rows(lib.catalog.relations) == before  # the version before is whole
    monkeypatch.undo()
    monkeypatch.setattr(library, "MERGED", 1)
    lib.refresh()
    assert len(lib.store.pointer()["more"]["folders"]) == 1
    same_as_a_full_build(spark, lib, folder)


def test_values_that_become_hot(spark, folder, tmp_path, monkeypatch):
    """A value that comes to be in very many columns changes what other pairs share besides."""
    monkeypatch.setattr(D, "HOT_COLUMNS", 3)
    lib = Library(spark, str(folder), str(tmp_path / "store"))
    lib.refresh()
    write(folder / "more.csv", "a_id,b_id\n" + "".join(f"{i + 500},{i + 500}\n" for i in range(40)), 2000)
    lib.refresh()
    same_as_a_full_build(spark, lib, folder)


def test_a_sheet_much_larger_than_the_others_comes(spark, folder, tmp_path, monkeypatch):
    """Its values are joined in another way than those of the others, in one plan with them."""
    monkeypatch.setattr(D, "HOT_COLUMNS", 6)  # of more columns, but no value is in more than 6
    lib = Library(spark, str(folder), str(tmp_path / "store"))
    lib.refresh()
    write(folder / "skill.csv", "id,hero_id,kind\n" + "".join(f"{i + 500},{i % 55 + 1},k{i % 3}\n" for i in range(150)), 2000)
    write(folder / "more.csv", "a_id,b_id\n" + "".join(f"{i + 500},{i + 500}\n" for i in range(4000)), 2000)
    lib.refresh()
    same_as_a_full_build(spark, lib, folder)


def test_stream(spark, folder, tmp_path):
    lib = Library(spark, str(folder), str(tmp_path / "store"))
    stream = keep_fresh(spark, lib.refresh, str(tmp_path / "checkpoint"), 1)
    try:
        end = time.time() + 120
        while not lib.store.pointer()["number"] and time.time() < end and stream.isActive:
            time.sleep(0.5)
    finally:
        stream.stop()
    assert lib.catalog.tables.where(F.col("table") == "hero").count() == 1
