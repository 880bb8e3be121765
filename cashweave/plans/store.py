"""Tables of a run below one directory, and layers whose tables change together.

A layer is written table by table; that is enough where a rerun writes it again. The
reference data outlive a run and belong together: a bridge must not point to products
that are not there yet. Such a layer is published: all its tables are written as a new
version beside the earlier ones, and one row added to the layer's commits makes that
version the current one. The row is one file that appears whole, by a rename, or not at
all, so whenever a run ends, readers see all tables of one version, and a reader that
has opened a version keeps it while the next one is published.

    <layer>/versions/<version>/<table>     never written over
    <layer>/commits                        sequence, version, tables, published_at
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cashweave.sources import feeds

_SUM = "decimal(38,6)"
_METRICS = f"sums map<string, {_SUM}>"
_COMMIT = "sequence long, version string, tables array<string>, published_at timestamp"


def _found(read) -> DataFrame | None:
    """What read() opens, or None where nothing has been written."""
    try:
        return read()
    except AnalysisException as error:
        # A table that is there but broken must not pass for an empty one.
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@dataclass(frozen=True)
class Version:
    """One published state of a layer: all tables read from it belong together."""

    store: Store
    layer: str
    sequence: int
    name: str
    tables: tuple[str, ...]

    def read(self, table: str) -> DataFrame:
        if table not in self.tables:
            raise ValueError(f"version {self.sequence} of {self.layer!r} has no table {table!r}, only {list(self.tables)}")
        return self.store.spark.read.parquet(self.store.version_path(self.layer, self.name, table))

    def find(self, table: str) -> DataFrame | None:
        return self.read(table) if table in self.tables else None


@dataclass(frozen=True)
class Store:
    """Tables below one directory, as ``<layer>/<name>``."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def version_path(self, layer: str, version: str, table: str) -> str:
        return self.path(layer, f"versions/{version}/{table}")

    def write(
        self, df: DataFrame, layer: str, name: str, mode: str = "overwrite", by: str | None = None
    ) -> None:
        writer = df.write.mode(mode)
        (writer.partitionBy(by) if by else writer).parquet(self.path(layer, name))

    def write_observed(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        metrics: dict[str, Column],
        mode: str = "overwrite",
        by: str | None = None,
    ) -> None:
        """Write a table and, from the same pass, sums over its rows (counts or decimals).

        They are gathered in the tasks that write, so a task that is run again counts
        once. ``metrics`` gives them back, added up over what was appended. Sums of the
        table before are dropped first: a run that ends in between leaves none.
        """
        if mode == "overwrite":
            empty = self.spark.createDataFrame([], _METRICS)
            self.write(empty, "metrics", f"{layer}/{name}")
        seen = Observation()
        self.write(df.observe(seen, *[c.cast(_SUM).alias(n) for n, c in metrics.items()]), layer, name, mode, by)
        got = seen.get
        row = self.spark.createDataFrame([({n: got.get(n) or Decimal(0) for n in metrics},)], _METRICS)
        self.write(row.coalesce(1), "metrics", f"{layer}/{name}", mode="append")

    def metrics(self, layer: str, name: str) -> dict[str, Decimal] | None:
        """The sums of a table, or None where they were not observed."""
        rows = self.find("metrics", f"{layer}/{name}")
        found = [r["sums"] for r in rows.collect()] if rows is not None else []
        if not found:
            return None
        return {n: sum((f[n] for f in found), Decimal(0)) for n in found[0]}

    def read(self, layer: str, name: str) -> DataFrame:
        """A table of a layer; of a published layer that of the current version."""
        version = self.current(layer)
        return version.read(name) if version else self.spark.read.parquet(self.path(layer, name))

    def find(self, layer: str, name: str) -> DataFrame | None:
        """The table, or None where it has not been written."""
        version = self.current(layer)
        if version:
            return version.find(name)
        return _found(lambda: self.spark.read.parquet(self.path(layer, name)))

    def prepped(self, name: str) -> str:
        return self.path("prepped", f"{name}{feeds.PREPPED_SUFFIX}")

    def _commits(self, layer: str) -> DataFrame | None:
        return _found(lambda: self.spark.read.schema(_COMMIT).parquet(self.path(layer, "commits")))

    def versions(self, layer: str) -> list[Version]:
        """All published versions, the current one last."""
        commits = self._commits(layer)
        if commits is None:
            return []
        rows = commits.orderBy("sequence", "version").collect()
        return [Version(self, layer, r["sequence"], r["version"], tuple(r["tables"])) for r in rows]

    def current(self, layer: str) -> Version | None:
        """The version that readers see; None for a layer that is not published."""
        return next(reversed(self.versions(layer)), None)

    def publish(self, layer: str, tables: dict[str, DataFrame]) -> Version:
        """Make the tables, and all others of the current version, the next version.

        Nothing of it is seen before all of it is. A table may be computed from the
        current version, which stays as it is. Tables that are not given are written
        again, so that a version can be read, and dropped, by itself.
        """
        before = self.current(layer)
        kept = {n: before.read(n) for n in before.tables if n not in tables} if before else {}
        name = uuid.uuid4().hex
        whole = {**kept, **tables}
        for table, df in whole.items():
            self.write(df, layer, f"versions/{name}/{table}", mode="errorifexists")
        version = Version(self, layer, before.sequence + 1 if before else 1, name, tuple(sorted(whole)))
        self._commit(version)
        return version

    def _commit(self, version: Version) -> None:
        row = self.spark.createDataFrame(
            [(version.sequence, version.name, list(version.tables))], "sequence long, version string, tables array<string>"
        )
        stamped = row.withColumn("published_at", F.current_timestamp()).coalesce(1)
        stamped.write.mode("append").parquet(self.path(version.layer, "commits"))

    def drop_old(self, layer: str, keep: int = 2) -> list[str]:
        """Delete all but the last ``keep`` versions, and what ended runs have left; gives their names.

        Not while a run publishes: what it has written so far looks like a leaving.
        """
        if keep < 1:
            raise ValueError("the current version has to stay")
        spark = self.spark
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path(layer, "versions"))
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        names = {v.name for v in self.versions(layer)[-keep:]}
        gone = sorted(s.getPath().getName() for s in files.listStatus(root) if s.getPath().getName() not in names)
        for name in gone:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(root, name), True)
        return gone
