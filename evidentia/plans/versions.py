"""Versioned manifests: which parts of a folder make up a table."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Versions:
    """Small tables ``manifest/v1``, ``v2``, ... under a path; a version counts once it is whole, and readers keep the one they have begun with.

    Writers take turns: two that publish at a time would claim one number.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def place(self, *parts: str):
        """A Hadoop path below this one, and its file system."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self, *parts: str) -> list[str]:
        place, fs = self.place(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def known(self) -> list[int]:
        _, fs = self.place()
        return sorted(int(n[1:]) for n in self.names("manifest") if fs.exists(self.place("manifest", n, "_SUCCESS")[0]))

    def rows(self, version: int | None = None) -> list[tuple]:
        """The rows of a version, the newest if None; none before the first."""
        known = self.known()
        return [tuple(r) for r in self.spark.read.schema(self.schema).parquet(f"{self.path}/manifest/v{version or known[-1]}").collect()] if known else []

    def publish(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v{max(self.known(), default=0) + 1}")

    def drop(self, *parts: str) -> None:
        place, fs = self.place(*parts)
        fs.delete(place, True)

    def keep_last(self, n: int) -> list[int]:
        """Deletes all versions but the last n, which are returned."""
        known = self.known()
        for version in known[:-n]:
            self.drop("manifest", f"v{version}")
        return known[-n:]
