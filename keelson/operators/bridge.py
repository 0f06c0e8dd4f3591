"""From Chinese column names to tables with English names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vocabulary import CN_REFERENCE_ENDINGS, ENTITIES, STEM_ENDINGS
from ..functions.values import without_ending


def entity_tables(tables: DataFrame) -> DataFrame:
    """(entity, table, rank): tables an entity may stand for: by name, by the name's stem, by its beginning (the shortest first)."""
    rows = [(e, k, n) for e, names in ENTITIES.items() for k, n in enumerate(names)]
    known = tables.sparkSession.createDataFrame(rows, "entity string, place int, name string")
    low, stem = F.lower("table"), without_ending(F.col("table"), STEM_ENDINGS)
    cut = F.split(low, "_")
    begun = F.transform(F.sequence(F.lit(1), F.size(cut)), lambda n: F.array_join(F.slice(cut, F.lit(1), n), "_"))
    asked = tables.select("table", F.explode(F.array_distinct(F.concat(F.array(low, stem), begun))).alias("name"))
    how = F.when(low == F.col("name"), 0).when(stem == F.col("name"), 1).otherwise(2)
    return asked.join(known, "name").select("entity", "table", F.struct("place", how.alias("how"), F.length("table").alias("n"), "table").alias("rank"))


def chinese_names(words: DataFrame, ending: str) -> DataFrame:
    """(word, entity, column): what a Chinese sheet would call the column that refers to a word's table, one row for each entity that the word may stand for."""
    rows = [(n, e) for e, names in ENTITIES.items() for n in names]
    return words.join(words.sparkSession.createDataFrame(rows, "word string, entity string"), "word").withColumn("column", F.concat("entity", F.lit(ending)))


def bridged(columns: DataFrame, tables: DataFrame) -> DataFrame:
    """(column, to_table): for columns with Chinese names and an ending of a reference, the table of the entity nearest to the end."""
    ends = F.filter(F.lit(list(CN_REFERENCE_ENDINGS)), lambda e: F.col("column").endswith(e))
    named = columns.where(F.col("column").rlike("[\\u4e00-\\u9fff]")).where(F.size(ends) > 0).select("column").distinct()
    found = named.join(F.broadcast(entity_tables(tables)), F.contains(F.col("column"), F.col("entity")))
    end = F.instr(F.reverse("column"), F.reverse("entity"))
    w = Window.partitionBy("column").orderBy(end, F.desc(F.length("entity")), "rank")
    return found.withColumn("r", F.row_number().over(w)).where("r = 1").select("column", F.col("table").alias("to_table"))
