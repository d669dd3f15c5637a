"""Day tables whose days are replaced in one step.

A write puts its rows into a folder of its own (``data/commit=<id>/<key>=<day>``) and
then publishes a manifest that names, for every day of the table, the folder its rows
are in. The manifest with the highest number is the table: readers see the days as
they were before a write or as they are after it, never a mix, and a write that fails
before its manifest leaves no trace but files that nobody reads (``vacuum``).

Manifests are numbered; a new one is moved to its name only if that name is free, so
of two writers one sees the other's manifest. It tries again on top of it if they
replaced different days, and fails otherwise. A manifest has one line per day.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.operators.timeframe import as_date

MANIFESTS, DATA, COMMIT = "_manifests", "data", "commit"


class Conflict(RuntimeError):
    """Another writer has replaced the same days in the meantime."""


class DayTable:
    """A versioned table at ``path``, partitioned by the date column ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str = "day"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        jvm = spark.sparkContext._jvm
        self._fs_pkg = jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._fs_pkg.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    # -- manifests --------------------------------------------------------

    def versions(self) -> list[int]:
        """Numbers of the published manifests, in order."""
        return sorted(int(n[:-5]) for n in self._names(MANIFESTS) if n.endswith(".json") and n[:-5].isdigit())

    def days(self, version: int | None = None) -> dict[dt.date, str]:
        """Folder of each day in a version, by default in the latest one; no days if there is none."""
        if version is None:
            published = self.versions()
            if not published:
                return {}
            version = published[-1]
        stream = self._fs.open(self._at(f"{MANIFESTS}/{version:012d}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {dt.date.fromisoformat(d): folder for d, folder in json.loads(text)["days"].items()}

    def _publish(self, version: int, days: dict[dt.date, str]) -> bool:
        """Give a new manifest its name; False if another writer has taken the number."""
        body = json.dumps({"version": version, "days": {d.isoformat(): f for d, f in sorted(days.items())}}, indent=0)
        draft = self._at(f"{MANIFESTS}/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(body.encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(getattr(self._fs_pkg, "Options$Rename"), 0)
        context = self._fs_pkg.FileContext.getFileContext(draft.toUri(), self._conf)
        try:  # without the option to overwrite, a taken name is an error
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(
                self._at(f"{MANIFESTS}/{version:012d}.json")), options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            self._fs.delete(draft, False)
            return False
        return True

    # -- rows ---------------------------------------------------------------

    def replace_days(self, df: DataFrame, start, end=None, attempts: int = 20) -> int:
        """Replace the days [start, end] (or from ``start`` on) with the rows of ``df``, days without rows
        included; all at once. Returns the version that has them."""
        start, end = as_date(start), None if end is None else as_date(end)
        before = self.versions()
        base = self.days(before[-1]) if before else {}
        folder = f"{DATA}/{COMMIT}={uuid.uuid4().hex}"
        # REBALANCE groups rows by day for the partitioned write and lets AQE split a large day
        df.hint("rebalance", self.key).write.partitionBy(self.key).parquet(f"{self.path}/{folder}")
        prefix = f"{self.key}="
        written = {}
        for name in self._names(folder):
            if name.startswith(prefix) and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
                written[dt.date.fromisoformat(name[len(prefix):])] = folder

        def mine(day: dt.date) -> bool:
            return start <= day and (end is None or day <= end)

        if outside := [d for d in written if not mine(d)]:
            raise ValueError(f"rows of {min(outside)} are not in the days that are replaced")
        seen = base
        for _ in range(attempts):
            version = (before[-1] if before else 0) + 1
            if self._publish(version, {d: f for d, f in seen.items() if not mine(d)} | written):
                return version
            before = self.versions()
            seen = self.days(before[-1])
            changed = [d for d in seen.keys() | base.keys() if seen.get(d) != base.get(d) and mine(d)]
            if changed:
                raise Conflict(f"{self.path}: {min(changed)} has been replaced by another writer")
        raise Conflict(f"{self.path}: no free version after {attempts} attempts")

    def read(self, schema: T.StructType | str, start=None, end=None, version: int | None = None) -> DataFrame:
        """The rows of the days [start, end] in a version (by default the latest); only their folders are listed.

        ``schema`` are the table's columns, the key included.
        """
        if isinstance(schema, str):
            schema = T._parse_datatype_string(schema)
        low, high = (None if d is None else as_date(d) for d in (start, end))
        wanted = [f"{self.path}/{folder}/{self.key}={day.isoformat()}" for day, folder in sorted(self.days(version).items())
                  if (low is None or low <= day) and (high is None or day <= high)]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*[f for f in schema.fields if f.name != self.key], T.StructField(COMMIT, T.StringType()),
                               T.StructField(self.key, T.DateType())])
        return (self.spark.read.schema(stored).option("basePath", f"{self.path}/{DATA}").parquet(*wanted)
                .select(*[F.col(f.name) for f in schema.fields]))

    def vacuum(self, keep: int = 2, can_go: Callable[[str], bool] = lambda folder: True) -> list[str]:
        """Delete the folders that none of the last ``keep`` versions reads, and older manifests; returns the folders.

        A write under way has no manifest yet: call this when none is, or let ``can_go`` spare young folders.
        """
        published = self.versions()
        used = {folder for v in published[-keep:] for folder in self.days(v).values()}
        gone = [f"{DATA}/{n}" for n in self._names(DATA) if n.startswith(f"{COMMIT}=")]
        gone = [f for f in gone if f not in used and can_go(f)]
        for v in published[:-keep]:
            self._fs.delete(self._at(f"{MANIFESTS}/{v:012d}.json"), False)
        for folder in gone:
            self._fs.delete(self._at(folder), True)
        return gone


def is_versioned(spark: SparkSession, path: str) -> bool:
    """True if a ``DayTable`` has been written at ``path``."""
    return bool(DayTable(spark, path).versions())
