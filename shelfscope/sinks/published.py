"""Tables and values that become visible together.

A state is a folder of immutable data folders and a log of numbered versions. A version is a
small JSON file naming the folders that make up each table, and plain values (watermarks,
flags, schemas). Data is written first, under new names; the version's file appears last, in
one step that fails if the number is taken. So a reader sees all of a run or nothing of it, a
run that failed half-way changed nothing, and of two concurrent runs one has to start over.
Nothing is overwritten in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..session import path_exists


class VersionTaken(RuntimeError):
    """Another run published this version first."""


@dataclass(frozen=True)
class Version:
    """``tables``: name -> the folders whose rows make it up; ``values``: name -> plain value."""

    number: int = 0
    tables: Mapping[str, Sequence[str]] = field(default_factory=dict)
    values: Mapping[str, object] = field(default_factory=dict)


class Published:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.base, *parts]))

    def _files(self):
        return self._path("_versions").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    # -- reading -------------------------------------------------------------------------
    def numbers(self) -> list[int]:
        if not path_exists(self.spark, f"{self.base}/_versions"):
            return []
        names = [f.getPath().getName() for f in self._files().listStatus(self._path("_versions"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def current(self) -> Version:
        """The newest version; the empty one before the first."""
        numbers = self.numbers()
        return self.version(numbers[-1]) if numbers else Version()

    def version(self, number: int) -> Version:
        stream = self._files().open(self._path("_versions", f"{number:08d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        v = json.loads(text)
        return Version(v["number"], v["tables"], v["values"])

    def read(self, name: str, schema=None, at: Version | None = None) -> DataFrame | None:
        """The rows of a table, None before it exists."""
        parts = (at or self.current()).tables.get(name)
        if not parts:
            return None
        r = self.spark.read
        return (r.schema(schema) if schema is not None else r).parquet(*[f"{self.base}/{p}" for p in parts])

    # -- writing -------------------------------------------------------------------------
    def stage(self, name: str, rows: DataFrame) -> str:
        """Rows written to a folder of their own that no version names yet."""
        part = f"{name}/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(f"{self.base}/{part}")
        return part

    def commit(self, after: Version, tables: Mapping[str, Sequence[str]], values: Mapping[str, object]) -> Version:
        """Publishes version ``after`` + 1: the given tables and values, others as they were.
        Raises VersionTaken if another run was faster."""
        new = Version(after.number + 1, {**after.tables, **{k: list(v) for k, v in tables.items()}}, {**after.values, **values})
        text = json.dumps({"number": new.number, "tables": new.tables, "values": new.values}, sort_keys=True)
        fs, hadoop = self._files(), self.spark._jvm.org.apache.hadoop.fs
        fs.mkdirs(self._path("_versions"))
        draft, final = self._path("_versions", f"draft-{uuid.uuid4().hex}"), self._path("_versions", f"{new.number:08d}.json")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = hadoop.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        options[0] = getattr(hadoop, "Options$Rename").NONE
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(final), options)   # fails if the target exists
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise VersionTaken(f"version {new.number} of {self.base}") from e
            raise
        return new
