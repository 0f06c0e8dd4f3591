"""A set of tables and what is derived from it, each part worked out once per session.

A part is written to the folder that the cluster shares when it is first asked for, as later
parts start from it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analysis as N
from ..operators import assets as A
from ..operators import discovery as D
from ..operators import profile as P
from ..operators.settings import Settings
from .store import stored

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
_catalogs: dict[tuple[str, str], Catalog] = {}


class Catalog:
    """Tables and what follows from them.

    With ``isolated`` a strategy of discovery that fails adds its error to ``failures`` and no relations, and the others go on;
    without it the error is raised.
    """

    def __init__(self, spark: SparkSession, sources: dict[str, DataFrame], feedback: DataFrame | None = None, settings: Settings = D.USUAL, isolated: bool = False):
        self.spark, self.sources, self.feedback, self.settings, self.isolated = spark, sources, feedback, settings, isolated
        self.failures: dict[str, str] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Catalog:
        """The catalog of the Parquet tables in a folder."""
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _catalogs:
            _catalogs[key] = cls(spark, {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES})
        return _catalogs[key]

    def _keep(self, df: DataFrame) -> DataFrame:
        return stored(df, "catalog")

    def _strategy(self, name: str, find: Callable[[], DataFrame]) -> DataFrame:
        """The relations that a strategy finds, written as they are found, so that its failures show here."""
        try:
            return self._keep(find())
        except (PySparkException, Py4JError) as e:
            if not self.isolated:
                raise
            self.failures[name] = str(e).splitlines()[0]
            return self.spark.createDataFrame([], ", ".join(f"{c} {'double' if c == 'confidence' else 'string'}" for c in D.RELATION))

    @cached_property
    def cells(self) -> DataFrame:
        return self._keep(P.cells(self.sources))

    @cached_property
    def kinds(self) -> DataFrame:
        return P.declared(self.spark, self.sources)

    @cached_property
    def columns(self) -> DataFrame:
        return self._keep(P.columns(self.cells, self.kinds))

    @cached_property
    def tables(self) -> DataFrame:
        return self._keep(P.tables(self.columns))

    @cached_property
    def norm(self) -> DataFrame:
        return self._keep(D.normalised(self.cells))

    @cached_property
    def candidates(self) -> DataFrame:
        return self._keep(D.candidates(self.columns, self.norm, self.settings))

    @cached_property
    def overlaps(self) -> DataFrame:
        return self._keep(D.overlaps(self.norm, self.candidates))

    @cached_property
    def scores(self) -> DataFrame:
        return self._keep(D.scores(self.overlaps, self.candidates, self.settings))

    @cached_property
    def containment(self) -> DataFrame:
        return self._strategy("containment", lambda: D.containment(D.adjusted(self.scores, self.settings)))

    @cached_property
    def naming(self) -> DataFrame:
        return self._strategy("naming", lambda: D.naming(self.columns, self.tables, self.norm))

    @cached_property
    def direct(self) -> DataFrame:
        """Containment and naming relations, and the abbreviations that follow from them."""
        found = self._keep(self.containment.unionByName(self.naming))
        return self._keep(found.unionByName(self._strategy("abbreviation", lambda: D.abbreviated(self.columns, self.tables, self.norm, found, self.settings))))

    @cached_property
    def transitive(self) -> DataFrame:
        return self._strategy("transitive", lambda: D.transitive(self.direct, self.settings.chained))

    @cached_property
    def all_relations(self) -> DataFrame:
        return self._keep(self.direct.unionByName(self.transitive))

    @cached_property
    def relations(self) -> DataFrame:
        return self._keep(D.final(self.all_relations, self.feedback, self.settings))

    @cached_property
    def analysis(self) -> DataFrame:
        return N.analysis(self.nodes, self.relations)

    @cached_property
    def starts(self) -> DataFrame | None:
        """(table, data_start_row), where the tables come from sheets."""
        return None

    @cached_property
    def rows_by_key(self) -> DataFrame:
        """(table, key, row) of the tables of at most 200 rows, in order of their keys."""
        small = self.tables.where("row_count <= 200 and primary_key is not null").select("table", "primary_key").collect()  # a row per table
        none = self.spark.createDataFrame([], "table string, key string, row bigint")
        return reduce(DataFrame.union, (A.row_locator(self.sources[r["table"]], r["table"], r["primary_key"]) for r in small), none)

    @cached_property
    def nodes(self) -> DataFrame:
        return self.tables.select(F.col("table"))
