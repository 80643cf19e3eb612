"""A table parted by a key (such as the genus) whose parts are replaced, merged and cleared as one commit.

<path>/data-<id>/_by=<key>/  the files of the parts that one commit wrote
<path>/versions/<number>     for each version, the folder of every part that is in it

A commit writes its files first and then one small version file, under a name that must be new. Readers take the newest version
and so see all of a commit or nothing; a writer that fails leaves only files that no version names, and one that another has
overtaken is told so. Only the names of the parts pass through the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Overtaken(RuntimeError):
    """Another writer has committed the version that this one was to be."""


class VersionedTable:
    """The table at a path, parted by column `by` (of a simple type), with the given schema for reading it while it is empty."""

    def __init__(self, spark: SparkSession, path: str, by: str, schema: str):
        self.spark, self.path, self.by, self.schema = spark, path.rstrip("/"), by, schema
        hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._path = hadoop.fs.Path
        self._system = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        self._folder = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils

    def _listed(self, folder: str) -> list[str]:
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._system.listStatus(at)) if self._system.exists(at) else []

    def versions(self) -> list[int]:
        """The numbers of the versions that are there, oldest first."""
        return [int(n) for n in self._listed(f"{self.path}/versions") if n.isdigit()]

    def parts(self, version: int | None = None) -> dict[str, str]:
        """Folder of each part of a version (the newest, if none is given), by the part's name."""
        there = self.versions()
        if version is None and not there:
            return {}
        stream = self._system.open(self._path(f"{self.path}/versions/{there[-1] if version is None else version:012d}"))
        try:
            return json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def name_of(self, value: object) -> str:
        """The name of the part of a value."""
        return "_by=" + (self._folder.DEFAULT_PARTITION_NAME() if value is None or value == "" else self._folder.escapePathName(str(value)))

    def read(self, values: list | None = None, version: int | None = None) -> DataFrame:
        """The table, or the parts of some values of it: no other part is looked at."""
        parts = self.parts(version)
        chosen = parts if values is None else {n: parts[n] for n in {self.name_of(v) for v in values} if n in parts}
        reader = self.spark.read.schema(self.schema)
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        return reader.option("recursiveFileLookup", "true").parquet(*(f"{self.path}/{f}" for f in sorted(chosen.values())))

    def _commit(self, base: int, parts: dict[str, str]) -> int:
        """Makes parts the version after base."""
        final, draft = self._path(f"{self.path}/versions/{base + 1:012d}"), self._path(f"{self.path}/versions/.draft-{uuid.uuid4().hex}")
        stream = self._system.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
        finally:
            stream.close()
        # rename() onto a name that is there says no; the check before it is for stores that would overwrite.
        if self._system.exists(final) or not self._system.rename(draft, final):
            self._system.delete(draft, False)
            raise Overtaken(f"version {base + 1} of {self.path} is there already")
        return base + 1

    def _written(self, rows: DataFrame) -> dict[str, str]:
        """Writes rows, one folder a part, and gives the folders."""
        folder = f"data-{uuid.uuid4().hex}"
        names = [c.split()[0] for c in self.schema.split(", ")]
        try:
            rows.select(*names, F.col(self.by).cast("string").alias("_by")).write.partitionBy("_by").parquet(f"{self.path}/{folder}")
        except BaseException:
            self._system.delete(self._path(f"{self.path}/{folder}"), True)
            raise
        return {n: f"{folder}/{n}" for n in self._listed(f"{self.path}/{folder}") if n.startswith("_by=")}

    def replace(self, rows: DataFrame, clear: list | None = None) -> int:
        """One commit: the parts that rows has values of hold just these rows, those of the `clear` values nothing, others stay.

        A value in `clear` that rows holds, too, is replaced. Returns the new version.
        """
        base = (self.versions() or [0])[-1]
        old = self.parts(base) if base else {}
        gone = {self.name_of(v) for v in clear or []}
        return self._commit(base, {n: f for n, f in old.items() if n not in gone} | self._written(rows))

    def merge(self, changes: DataFrame, *keys: str) -> int:
        """One commit: rows of changes take the place of those with the same keys in their part, and are added where there are none.

        Only parts that changes has values of are read and written. Of several changes of one key any may stay.
        """
        base = (self.versions() or [0])[-1]
        old = self.parts(base) if base else {}
        values = [r[0] for r in changes.select(self.by).distinct().collect()]  # one row a part
        before = self.read(values, base) if base else self.spark.createDataFrame([], self.schema)
        same = [self.by, *keys]
        new = changes.select(*before.columns).dropDuplicates(same).alias("n")
        stays = before.alias("b").join(new, [F.col(f"b.{k}").eqNullSafe(F.col(f"n.{k}")) for k in same], "left_anti")
        return self._commit(base, old | self._written(stays.unionByName(changes.select(*before.columns).dropDuplicates(same))))

    def clear(self, *values: object) -> int:
        """One commit that empties the parts of some values."""
        base = (self.versions() or [0])[-1]
        gone = {self.name_of(v) for v in values}
        return self._commit(base, {n: f for n, f in self.parts().items() if n not in gone})

    def vacuum(self, keep: int = 1) -> None:
        """Deletes all versions but the newest `keep` and every folder that none of these names. No writer may be at work."""
        there = self.versions()
        named = {f for v in there[-keep:] for f in self.parts(v).values()}
        for v in there[:-keep]:
            self._system.delete(self._path(f"{self.path}/versions/{v:012d}"), False)
        for folder in self._listed(self.path):
            if folder.startswith("data-"):
                for n in self._listed(f"{self.path}/{folder}"):
                    if n.startswith("_by=") and f"{folder}/{n}" not in named:
                        self._system.delete(self._path(f"{self.path}/{folder}/{n}"), True)
                if not any(f.startswith(f"{folder}/") for f in named):
                    self._system.delete(self._path(f"{self.path}/{folder}"), True)
