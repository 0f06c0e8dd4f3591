"""Tables kept as versions: the parts of a version are written first, the pointer that names them last.

``<path>/data/<version>/<part>`` holds the parts, ``<path>/pointers/<number>.json`` what each part of that number is.  A pointer
appears by a rename that fails if another has taken its number, so readers see a whole version or the one before, whatever happens to a writer.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    @property
    def _files(self):
        return self._at(self.path).getFileSystem(self._conf)

    def _numbers(self) -> list[int]:
        found = self._files.globStatus(self._at(f"{self.path}/pointers/*.json"))
        return sorted(int(x.getPath().getName().removesuffix(".json")) for x in found or [])

    def _pointer(self, number: int) -> str:
        return f"{self.path}/pointers/{number:012d}.json"

    def pointer(self, number: int | None = None) -> dict:
        """What a version holds: {number, parts: {name: path}, more}; of the latest one, and empty before the first."""
        numbers = self._numbers()
        if not numbers:
            return {"number": 0, "parts": {}, "more": {}}
        number = numbers[-1] if number is None else number
        stream = self._files.open(self._at(self._pointer(number)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")) | {"number": number}
        finally:
            stream.close()

    def begin(self) -> Draft:
        return Draft(self, self.pointer())

    def read(self, part: str) -> DataFrame:
        parts = self.pointer()["parts"]
        if part not in parts:
            raise ValueError(f"no such part: {part}")
        return self.spark.read.parquet(parts[part])

    def commit(self, number: int, parts: dict[str, str], more: dict) -> None:
        """Makes version ``number`` the latest; fails if it is there already."""
        files, draft = self._files, self._at(f"{self.path}/pointers/.{uuid.uuid4().hex}")
        out = files.create(draft)
        out.write(bytearray(json.dumps({"parts": parts, "more": more}).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(context.makeQualified(draft), context.makeQualified(self._at(self._pointer(number))), none)

    def remove(self, path: str) -> None:
        self._files.delete(self._at(path), True)

    def move(self, source: str, target: str) -> None:
        """Renames a file; what is at the target is replaced."""
        files = self._files
        files.mkdirs(self._at(target).getParent())
        files.delete(self._at(target), False)
        if not files.rename(self._at(source), self._at(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def found(self, pattern: str) -> list[str]:
        return [x.getPath().toString() for x in self._files.globStatus(self._at(pattern)) or []]

    def prune(self, keep: int = 2) -> None:
        """Removes all but the latest ``keep`` versions, and the data that none of those names.  Not while another writes."""
        numbers = self._numbers()
        kept = [self.pointer(n) for n in numbers[-keep:]]
        named = {x.split(f"{self.path}/data/", 1)[1].split("/")[0] for p in kept for x in [*p["parts"].values(), *p["more"].get("folders", [])]}
        for n in numbers[:-keep]:
            self._files.delete(self._at(self._pointer(n)), False)
        for x in self._files.globStatus(self._at(f"{self.path}/data/*")) or []:
            if x.getPath().getName() not in named:
                self._files.delete(x.getPath(), True)


class Draft:
    """A version that is being written; it counts once it is committed."""

    def __init__(self, store: Versions, before: dict):
        self.store, self.before, self.parts = store, before, dict(before["parts"])
        self.folder = f"{store.path}/data/{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """df as written."""
        df.write.parquet(f"{self.folder}/{name}")
        self.parts[name] = f"{self.folder}/{name}"
        return self.store.spark.read.schema(df.schema).parquet(self.parts[name])

    def put_lines(self, name: str, df: DataFrame, order: tuple[str, ...] = ()) -> None:
        """df as JSON lines in one file, in this order; with an order, the column ``text`` alone as lines of text."""
        one = df.repartition(1).sortWithinPartitions(*order).select("text") if order else df.coalesce(1)
        (one.write.text if order else one.write.json)(f"{self.folder}/{name}")
        self.parts[name] = f"{self.folder}/{name}"

    def commit(self, more: dict | None = None) -> int:
        """The number of the new version; parts that were not written are those of the one before."""
        number = self.before["number"] + 1
        self.store.commit(number, self.parts, more or {})
        return number
