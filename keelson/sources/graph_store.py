"""A catalog's graph on disk, as versions: tables, columns with a few values, relations, change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.profile import samples
from ..plans.catalog import Catalog
from .versions import Versions

STORED_VALUES, STORED_CHANGES = 30, 200
PARTS = ("tables", "columns", "values", "relations", "changelog")


def save(catalog: Catalog, path: str, changelog: DataFrame | None = None) -> int:
    """Writes the graph as a new version, which readers see when all of it is there.

    Values are cut to 30 a column here only: discovery always works on all of them.
    """
    parts = {"tables": catalog.tables, "columns": catalog.columns, "values": samples(catalog.cells, STORED_VALUES), "relations": catalog.relations}
    if changelog is not None:
        parts["changelog"] = changelog.orderBy("table", "change_type").limit(STORED_CHANGES)
    store = Versions(catalog.spark, path)
    draft = store.begin()
    for name, df in parts.items():
        draft.put(name, df)
    number = draft.commit()
    store.prune()
    return number


def load(spark: SparkSession, path: str, part: str) -> DataFrame:
    if part not in PARTS:
        raise ValueError(f"no such part: {part}")
    return Versions(spark, path).read(part)
