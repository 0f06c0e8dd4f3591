"""The thresholds of discovery."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    #: Values a candidate column has at least, and candidate columns a table has at most.
    min_values: int = 3
    per_table: int = 80
    #: Values that two columns share at least; the second if one of them is named like an identifier.
    min_shared: int = 5
    min_shared_id: int = 3
    #: Least share of a column's values in the other; the second for a reference to a key.
    containment: float = 0.80
    id_containment: float = 0.70
    #: Least Jaccard similarity of two columns of which neither contains the other.
    overlap: float = 0.80
    #: Keys of fewer values are small; relations from containment below ``weak`` are dropped.
    small_key: int = 50
    weak: float = 0.30
    #: Least confidence of relations that abbreviations are mined from, of links of a chain, and of the result.
    mined_from: float = 0.80
    chained: float = 0.65
    final: float = 0.50
    #: Relations of two tables at most.
    per_pair: int = 2

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Settings:
        """From a text file of lines ``name: value``; blank lines and those that begin with # are left out.

        A name that is no setting, a name twice and a value that is no number are errors; settings that are not named keep their value.
        """
        kinds = {f.name: int if isinstance(f.default, int) else float for f in fields(cls)}
        given: dict[str, int | float] = {}
        for row in spark.read.text(path).collect():  # a file of settings, not of data
            line = row["value"].strip()
            if not line or line.startswith("#"):
                continue
            name, colon, value = (part.strip() for part in line.partition(":"))
            if not colon or name not in kinds or name in given:
                raise ValueError(f"no setting, or named twice: {line}")
            try:
                given[name] = kinds[name](value.strip("\"'"))
            except ValueError:
                raise ValueError(f"no number: {line}") from None
        return cls(**given)
