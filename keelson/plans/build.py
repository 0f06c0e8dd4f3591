"""From a folder of files to a catalog, and from a catalog to the assets on disk."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import as_text, is_compound
from ..functions.vocabulary import TYPE_WORDS
from ..operators import analysis as N
from ..operators import assets as A
from ..operators import discovery as D
from ..operators import graph as G
from ..operators import profile as P
from ..operators.settings import Settings
from ..sources import files, graph_store
from ..sources.versions import Versions
from .catalog import Catalog


class SheetCatalog(Catalog):
    """The catalog of the sheets in a folder.

    The first row of a sheet names its columns (blank names become ``Unnamed: k``, repeated ones get .1, .2 and so on); the rows of types,
    names and descriptions behind it are skipped.  Cells are read as text, blank ones as null, and cells beyond the first row's belong
    to unnamed columns.  Of several files of one stem the first by path counts.  All sheets are profiled in one job, however many they are.
    """

    def __init__(self, spark: SparkSession, folder: str, feedback: DataFrame | None = None, settings: Settings = D.USUAL, isolated: bool = False):
        super().__init__(spark, {}, feedback, settings, isolated)
        self.folder = folder

    @cached_property
    def read(self) -> DataFrame:
        return self._keep(files.read(self.spark, self.folder))

    @cached_property
    def errors(self) -> DataFrame:
        """(path, error): files that cannot be read, and files whose sheets another file of the same stem has."""
        rows = self.read.where("source is not null").select("source", "path").distinct()
        second = rows.join(self._first, "source").where("path <> first").select("path", F.concat(F.lit("same name as "), "first").alias("error"))
        return self.read.where("source is null").select("path", F.get("cells", F.lit(0)).alias("error")).union(second)

    @cached_property
    def _first(self) -> DataFrame:
        return self.read.where("source is not null").groupBy("source").agg(F.min("path").alias("first"))

    @cached_property
    def rows(self) -> DataFrame:
        """(table, row_index, row, cells), the header's row included."""
        return self.read.join(self._first, "source").where("path = first").select(F.col("source").alias("table"), "row_index", "row", "cells")

    @cached_property
    def headers(self) -> DataFrame:
        """(table, names, header_rows, start): the names of all columns, the rows to skip behind the first, and the number of the first row of data in the sheet."""
        width = self.rows.groupBy("table").agg(F.max(F.size("cells")).alias("width"))
        top = self.rows.where("row_index = 0").join(width, "table")
        at = F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("ordinal")
        cells = top.select("table", "cells", at).select("table", "ordinal", F.trim(F.coalesce(F.get("cells", F.col("ordinal")), F.lit(""))).alias("name"))
        cells = cells.withColumn("name", F.when(F.col("name") == "", F.concat(F.lit("Unnamed: "), "ordinal")).otherwise(F.col("name")))
        again = F.row_number().over(Window.partitionBy("table", "name").orderBy("ordinal")) - 1
        cells = cells.withColumn("name", F.when(again > 0, F.concat_ws(".", "name", again)).otherwise(F.col("name")))
        names = cells.groupBy("table").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "name"))), lambda x: x["name"]).alias("names"))
        below = self.rows.where("row_index > 0").select(F.col("table").alias("source"), (F.col("row_index") - 1).alias("row_index"), "cells")
        skipped = P.header_rows(below, TYPE_WORDS).withColumnRenamed("source", "table")
        known = names.join(skipped, "table", "left").select("table", "names", F.coalesce("header_rows", F.lit(0)).cast("int").alias("header_rows"))
        top = self.rows.where("row_index <= 10").join(known, "table").groupBy("table").agg(
            F.coalesce(F.min(F.when(F.col("row_index") > F.col("header_rows"), F.col("row"))), F.max("row") + 1).cast("bigint").alias("start")
        )
        return self._keep(known.join(top, "table"))

    @cached_property
    def data(self) -> DataFrame:
        """(table, names, row, cells): rows of data; ``row`` is the number of the row in its sheet, from 1."""
        return self.rows.join(self.headers, "table").where("row_index > header_rows").select("table", "names", F.col("row").cast("bigint").alias("row"), "cells")

    @cached_property
    def cells(self) -> DataFrame:
        each = self.data.select("table", "cells", F.posexplode("names").alias("ordinal", "column"))
        value = F.get("cells", F.col("ordinal"))
        some = F.when(F.trim(value) != "", value)
        text = F.when(is_compound(F.col("column")), some).otherwise(as_text(some, T.StringType()))
        return self._keep(each.groupBy("table", "ordinal", "column", text.alias("value")).agg(F.count("*").alias("n")))

    @cached_property
    def kinds(self) -> DataFrame:
        return self.headers.select("table", F.explode("names").alias("column"), F.lit("str").alias("kind"))

    @cached_property
    def starts(self) -> DataFrame:
        return self.headers.select("table", F.col("start").alias("data_start_row"))

    @cached_property
    def rows_by_key(self) -> DataFrame:
        """(table, key, row): the place of each key in its sheet, for all sheets of at most 200 rows whose keys are unique."""
        keyed = self.data.join(self.tables.where("row_count <= 200 and primary_key is not null").select("table", "primary_key"), "table")
        at = F.array_position("names", F.col("primary_key")).cast("int") - 1
        found = keyed.select("table", F.get("cells", at).alias("key"), "row").where("key is not null")
        return found.withColumn("n", F.count("*").over(Window.partitionBy("table", "key"))).withColumn("n", F.max("n").over(Window.partitionBy("table"))).where("n = 1").drop("n")


#: The assets in the order in which they are written.
ASSETS: dict[str, Callable[[Catalog], DataFrame]] = {
    "schema_summary": lambda c: A.schema_summary(c.tables),
    "summary_text": lambda c: A.summary_text(c.tables, c.relations, c.analysis),
    "chunks_text": lambda c: A.chunks_text(c.tables, c.columns, c.relations),
    "llm_chunks": lambda c: A.llm_chunks(c.tables, c.columns, c.relations),
    "column_index": lambda c: A.column_index(c.columns),
    "column_index_cn": lambda c: A.cn_segments(c.columns),
    "relation_graph": lambda c: A.relation_graph(c.relations),
    "relation_evidence": lambda c: D.shared_values(c.relations, c.norm),
    "join_paths": lambda c: G.paths(c.relations, 2, 0.65),
    "table_profiles": lambda c: A.table_profiles(c.tables, c.columns, c.relations),
    "table_description": lambda c: A.table_description(c.tables),
    "analysis": lambda c: c.analysis,
    "analysis_summary": lambda c: N.summary(c.analysis),
    "value_index": lambda c: A.value_index(c.cells, c.columns),
    "domain_graph": lambda c: A.domain_graph(c.relations, c.tables),
    "enum_cross_ref": lambda c: A.enum_cross_ref(c.cells, c.columns),
    "cell_locator": lambda c: A.cell_locator(c.columns, c.starts),
    "row_locator": lambda c: c.rows_by_key,
    "report_nodes": lambda c: A.report_nodes(c.tables, G.degrees(c.nodes, c.relations)),
    "report_edges": lambda c: A.report_edges(c.relations),
    "report_dag": lambda c: G.acyclic(c.relations),
}


#: Assets that are texts, with the order of their lines.
TEXTS = {"summary_text": ("section", "place"), "chunks_text": ("table", "place")}


def export(catalog: Catalog, folder: str) -> DataFrame:
    """(asset, error): writes every asset below a folder, as JSON lines or text, as a new version of all of them.

    One that fails leaves its error, does not stop the others, and stays what it was in the version before.
    """
    store = Versions(catalog.spark, folder)
    draft, done = store.begin(), []
    for name, make in ASSETS.items():
        try:
            draft.put_lines(name, make(catalog), TEXTS.get(name, ()))
            done.append((name, None))
        except (PySparkException, Py4JError) as e:
            done.append((name, str(e).splitlines()[0]))
    draft.commit()
    store.prune()
    return catalog.spark.createDataFrame(done, "asset string, error string")


def build(spark: SparkSession, folder: str, out: str, feedback: DataFrame | None = None, settings: Settings = D.USUAL) -> tuple[SheetCatalog, DataFrame]:
    """The catalog of a folder of CSV, TSV and XLSX files, its graph and assets written below ``out``; and (asset, error).

    A strategy that fails is a row of the second too, named ``strategy: ...``; what the others find is written.
    """
    catalog = SheetCatalog(spark, folder, feedback, settings, isolated=True)
    graph_store.save(catalog, f"{out}/graph")
    done = export(catalog, f"{out}/assets")
    failed = [(f"strategy: {name}", error) for name, error in catalog.failures.items()]
    return catalog, done.union(spark.createDataFrame(failed, "asset string, error string"))
