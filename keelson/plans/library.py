"""A folder of sheets kept up to date: only files that changed are read again, only pairs of columns that changed are compared again.

What follows from one sheet alone (its cells, profile, values and candidate columns) is stored with the version that read it; the
list of sheets says which version each comes from.  What follows from pairs of columns is stored with a print of both
columns, so it holds as long as neither changes.  The rest is worked out anew from these parts.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import discovery as D
from ..sources import files
from ..sources.versions import Versions
from ..streaming.incremental import file_changes
from .build import SheetCatalog
from .store import stored

#: Versions from which sheets come before they are written together again.
MERGED = 8
#: Sheets of more rows have no row locator, so their rows are not kept.
SMALL_ROWS = 200
#: Parts that follow from a sheet alone; ``sheet`` names it (source and file, as several files may have a sheet of one name).
OF_A_SHEET = ("headers", "small", "cells", "columns", "norm", "candidates", "prints")
HELD = ("table", "column", "to_table", "to_column")


def prints(norm: DataFrame) -> DataFrame:
    """(table, column, print): what tells whether the values of a column changed, 128 bits."""
    total = lambda seed: F.sum(F.xxhash64("value", F.lit(seed)).cast("decimal(38,0)")).cast("string")
    return norm.groupBy("table", "column").agg(F.md5(F.concat_ws("|", F.count("*").cast("string"), total(0), total(1))).alias("print"))


class _Read(SheetCatalog):
    """The sheets of some files, each under a name of its own."""

    def __init__(self, spark: SparkSession, paths: list[str]):
        super().__init__(spark, "")
        self.paths = paths

    @cached_property
    def read(self) -> DataFrame:
        return self._keep(files.read(self.spark, self.paths))

    @cached_property
    def rows(self) -> DataFrame:
        return self.read.where("source is not null").select(F.concat_ws("\n", "source", "path").alias("table"), "row_index", "row", "cells")

    def part(self, name: str) -> DataFrame:
        if name == "small":
            few = self.data.groupBy("table").agg(F.count("*").alias("n")).where(F.col("n") <= SMALL_ROWS)
            return self.data.join(few.select("table"), "table")
        return prints(self.norm) if name == "prints" else getattr(self, name)


class StoredCatalog(SheetCatalog):
    """The catalog of a version."""

    def __init__(self, library: Library, sheets: DataFrame, folders: list[str], feedback: DataFrame | None = None):
        """sheets: (sheet, source, path, folder)."""
        super().__init__(library.spark, library.folder, feedback)
        self.sheets, self.folders = sheets, folders

    @cached_property
    def _named(self) -> DataFrame:
        """(sheet, folder, name): the sheets that are tables; of several of one name that of the first file."""
        first = self.sheets.groupBy("source").agg(F.min("path").alias("path"))
        return self._keep(self.sheets.join(first, ["source", "path"]).select("sheet", "folder", F.col("source").alias("name")))

    def part(self, name: str, sheets: DataFrame | None = None) -> DataFrame:
        """A part of all sheets that are tables, or of those given (sheet, folder, name)."""
        sheets = self._named if sheets is None else sheets
        if not self.folders:
            raise ValueError("no sheets were read")
        every = reduce(DataFrame.unionByName, (self.spark.read.parquet(f"{f}/{name}").withColumn("folder", F.lit(f)) for f in self.folders))
        columns = [c for c in every.columns if c not in ("table", "folder")]
        return every.withColumnRenamed("table", "sheet").join(sheets, ["sheet", "folder"]).select(F.col("name").alias("table"), *columns)

    headers = cached_property(lambda self: self.part("headers"))
    data = cached_property(lambda self: self.part("small"))
    cells = cached_property(lambda self: self.part("cells"))
    columns = cached_property(lambda self: self.part("columns"))
    norm = cached_property(lambda self: self.part("norm"))
    candidates = cached_property(lambda self: self._keep(self.part("candidates")))
    prints = cached_property(lambda self: self._keep(self.part("prints")))

    @cached_property
    def profiled(self) -> DataFrame:
        """The candidate columns with a print of their values and of all that scores depend on."""
        rows = self.candidates.join(self.prints, ["table", "column"])
        facts = ("dtype", "row_count", "unique_values", "is_id_like", "is_pk", "min_val", "max_val")
        return self._keep(rows.select("table", "column", F.md5(F.concat_ws("|", "print", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in facts))).alias("print")))


class Library:
    """A folder of CSV, TSV and XLSX files, and its relations, below ``store``."""

    def __init__(self, spark: SparkSession, folder: str, store: str, feedback: DataFrame | None = None):
        self.spark, self.folder, self.store, self.feedback = spark, folder, Versions(spark, store), feedback

    @property
    def catalog(self) -> StoredCatalog:
        """The catalog of the latest version; its parts stay those of that version."""
        pointer = self.store.pointer()
        return self._catalog(pointer, self.store.read("sheets"), pointer["more"]["folders"])

    def _catalog(self, pointer: dict, sheets: DataFrame, folders: list[str]) -> StoredCatalog:
        catalog = StoredCatalog(self, sheets, folders, self.feedback)
        for name in ("overlaps", "containment", "naming"):
            if name in pointer["parts"]:
                df = self.spark.read.parquet(pointer["parts"][name])
                catalog.__dict__[name] = df.drop("print_a", "print_b", "pair")
        failed = self.spark.read.parquet(pointer["parts"]["failed"]) if "failed" in pointer["parts"] else None
        if failed is not None:
            first = sheets.groupBy("source").agg(F.min("path").alias("first"))
            second = sheets.join(first, "source").where("path <> first").select("path", F.concat(F.lit("same name as "), "first").alias("error"))
            catalog.__dict__["errors"] = failed.union(second)
        return catalog

    def refresh(self) -> DataFrame:
        """(path, change) since the latest version.  If there are changes, a new version has them; it counts when all of it is written."""
        draft = self.store.begin()
        before = draft.before
        listed = stored(files.listing(self.spark, self.folder), "listing")
        none = self.spark.createDataFrame([], listed.schema)
        known = self.spark.read.parquet(before["parts"]["files"]) if "files" in before["parts"] else none
        changes = stored(file_changes(known, listed), "changes")
        if before["number"] and not changes.where("change <> 'unchanged'").limit(1).count():
            return changes
        again = changes.where("change in ('new', 'updated')").select("path")
        gone = changes.where("change <> 'unchanged'").select("path")
        paths = sorted(r["path"] for r in again.toLocalIterator())  # names of files that are read now
        old_sheets = self.spark.read.parquet(before["parts"]["sheets"]) if "sheets" in before["parts"] else self.spark.createDataFrame([], "sheet string, source string, path string, folder string")
        old_failed = self.spark.read.parquet(before["parts"]["failed"]) if "failed" in before["parts"] else self.spark.createDataFrame([], "path string, error string")
        sheets, failed, folders = old_sheets.join(gone, "path", "left_anti").select(*old_sheets.columns), old_failed.join(gone, "path", "left_anti"), list(before["more"].get("folders", []))
        if paths:
            read = _Read(self.spark, paths)
            for name in OF_A_SHEET:
                draft.put(name, read.part(name))
                del draft.parts[name]  # of a sheet: found by the list of sheets
            fresh = read.read.where("source is not null").select("source", "path").distinct()
            sheets = sheets.unionByName(fresh.select(F.concat_ws("\n", "source", "path").alias("sheet"), "source", "path", F.lit(draft.folder).alias("folder")))
            failed = failed.unionByName(read.read.where("source is null").select("path", F.get("cells", F.lit(0)).alias("error")))
            folders.append(draft.folder)
        sheets, failed = draft.put("sheets", sheets), draft.put("failed", failed)
        draft.put("files", listed)
        catalog = StoredCatalog(self, sheets, folders, self.feedback)
        if len(folders) > MERGED:  # all that is still used together
            merged = f"{draft.folder}/merged"
            for name in OF_A_SHEET:
                every = StoredCatalog(self, sheets, folders).part(name, sheets.select("sheet", "folder", F.col("sheet").alias("name")))
                every.write.parquet(f"{merged}/{name}")
            sheets = draft.put("sheets-merged", sheets.withColumn("folder", F.lit(merged)))
            draft.parts["sheets"] = draft.parts.pop("sheets-merged")
            folders, catalog = [merged], StoredCatalog(self, sheets, [merged], self.feedback)
        if folders:
            old = self._catalog(before, old_sheets, before["more"].get("folders", [])) if before["more"].get("folders") else None
            self._compare(draft, catalog, old)
        draft.commit({"folders": folders})
        self.store.prune()
        return changes

    def _compare(self, draft, catalog: StoredCatalog, old: StoredCatalog | None) -> None:
        """Stores what follows from pairs of columns: kept where both columns are as they were, else worked out."""
        now = catalog.profiled
        index = self.spark.read.parquet(draft.before["parts"]["overlaps"]) if "overlaps" in draft.before["parts"] else None
        side = lambda s: now.select(F.col("table").alias(f"table_{s}"), F.col("column").alias(f"column_{s}"), F.col("print").alias(f"print_{s}"))
        kept = None
        if index is not None and old is not None and not self._heat_changed(catalog, old):
            kept = stored(index.join(side("a"), ["table_a", "column_a", "print_a"], "left_semi").join(side("b"), ["table_b", "column_b", "print_b"], "left_semi"), "kept")
        if kept is None:
            fresh = D.overlaps(catalog.norm, catalog.candidates)
        else:
            new = now.join(old.profiled, ["table", "column", "print"], "left_anti").select("table").distinct()
            changed = tuple(r["table"] for r in new.toLocalIterator())  # names of tables with a column that changed
            fresh = D.overlaps(catalog.norm, catalog.candidates, changed=changed, known=kept)
        fresh = stored(fresh, "fresh")
        own = stored(D.containment(D.adjusted(D.scores(fresh, catalog.candidates))), "contained")
        printed = fresh.join(side("a"), ["table_a", "column_a"]).join(side("b"), ["table_b", "column_b"])
        columns = [*D.PAIR, "shared", "gated", "print_a", "print_b"]
        draft.put("overlaps", printed.select(*columns) if kept is None else kept.select(*columns).unionByName(printed.select(*columns)))
        if kept is not None:
            both = kept.select(*(F.concat_ws(".", f"table_{s}", f"column_{s}").alias(s) for s in "ab"))
            relations = self.spark.read.parquet(draft.before["parts"]["containment"])
            ends = relations.select("*", *(k.alias(n) for k, n in zip(D._pair(*D.RELATION[:4]), ("k1", "k2"))))
            both = both.select(F.least("a", "b").alias("k1"), F.greatest("a", "b").alias("k2"))
            own = own.unionByName(ends.join(both, ["k1", "k2"], "left_semi").select(*D.RELATION))
        catalog.__dict__["containment"] = draft.put("containment", own)
        self._name(draft, catalog)

    def _name(self, draft, catalog: StoredCatalog) -> None:
        """Relations from names, for which values are compared only where one of the two columns changed."""
        print_of = lambda t, c, p: catalog.prints.select(F.col("table").alias(t), F.col("column").alias(c), F.col("print").alias(p))
        known = None
        if "held" in draft.before["parts"]:
            known = self.spark.read.parquet(draft.before["parts"]["held"])
            for t, c, p in (("table", "column", "print_a"), ("to_table", "to_column", "print_b")):
                known = known.join(print_of(t, c, p), [t, c, p], "left_semi")
            known = stored(known.select(*HELD, "containment"), "known")
        found = D.naming(catalog.columns, catalog.tables, catalog.norm, known=known)
        named = draft.put("naming", found)
        edges = named.select(F.col("from_table").alias("table"), F.col("from_column").alias("column"), "to_table", "to_column").distinct()
        fresh = edges if known is None else edges.join(known, list(HELD), "left_anti")
        held = D.containments(fresh, catalog.norm)
        held = held if known is None else held.unionByName(known.join(edges, list(HELD), "left_semi"))
        draft.put("held", held.join(print_of("table", "column", "print_a"), ["table", "column"]).join(print_of("to_table", "to_column", "print_b"), ["to_table", "to_column"]))

    @staticmethod
    def _heat_changed(catalog: StoredCatalog, old: StoredCatalog) -> bool:
        """Whether a value came to be in very many columns, or ceased to: what pairs share besides it changes with that, changed or not.

        Each side is stored before they are compared: a join over unions of joins fails where their numbers of partitions come to differ.
        """
        if max(catalog.profiled.count(), old.profiled.count()) <= D.HOT_COLUMNS:
            return False
        moved = stored(catalog.profiled.unionByName(old.profiled).groupBy("table", "column", "print").count().where("count = 1").select("table", "column").distinct(), "moved")
        values = stored(catalog.norm.unionByName(old.norm).join(moved, ["table", "column"], "left_semi").select("value").distinct(), "moved-values")
        wide = lambda c: stored(c.norm.join(values, "value", "left_semi").join(c.candidates.select("table", "column"), ["table", "column"], "left_semi").groupBy("value").count().where(F.col("count") > D.HOT_COLUMNS).select("value"), "hot-values")
        now, then = wide(catalog), wide(old)
        return bool(now.join(then, "value", "left_anti").limit(1).count() or then.join(now, "value", "left_anti").limit(1).count())
