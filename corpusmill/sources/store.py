"""A table of rows by key that jobs resume from and caches live in.

Files are bucketed by key, so a lookup shuffles the rows that ask and never the
store: Spark reads a bucket where it joins. An upsert appends each bucket's new
rows under the next version, and the newest row of a key counts, which an
aggregation over a bucket finds in place. Rows that couldn't be made are kept
with their error, as an answer like any other, until they are asked to be tried
again. compact() writes the current rows to a new generation; readers take the
newest one that is whole, so one that was cut off in between harms nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "__version"


class KeyedStore:
    """Rows of `schema` (DDL), one for each value of `key`, under a folder. One job writes at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema, self.columns = schema, spark.createDataFrame([], schema).columns
        at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs, self._path = at.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path
        self._open(max(self._generations(), default=0))

    def _generations(self) -> list[int]:
        """The generations that are whole; the first one is from its beginning."""
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.path))]
        return [int(n[4:]) for n in names if n.startswith("gen=") and (int(n[4:]) == 0 or self._fs.exists(self._path(f"{self.path}/{n}/_WHOLE")))]

    def _name(self, generation: int) -> str:
        return f"keyed_{hashlib.sha256(f'{self.path}/{generation}'.encode()).hexdigest()[:16]}"

    def _declare(self, generation: int) -> str:
        """The table over a generation's files, as this session's catalog must know it."""
        name = self._name(generation)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({self.schema}, {VERSION} BIGINT) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}/gen={generation}'")
        return name

    def _open(self, generation: int) -> None:
        self.generation, self.name = generation, self._declare(generation)

    def _append(self, rows: DataFrame, name: str) -> None:
        dealt = rows.repartition(self.buckets, self.key)  # one file a bucket
        dealt.write.mode("append").format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(name)
        self.spark.catalog.refreshTable(name)

    def versions(self) -> DataFrame:
        return self.spark.table(self.name)

    def table(self) -> DataFrame:
        """The current rows: of each key the newest. No exchange: a bucket has all versions of its keys."""
        newest = self.versions().groupBy(self.key).agg(F.max_by(F.struct(*self.columns), VERSION).alias("r"))
        return newest.select(*[F.col(c) if c == self.key else F.col(f"r.`{c}`").alias(c) for c in self.columns])  # the key itself: Spark knows where it lies

    def missing(self, rows: DataFrame, key: str | None = None, retry: str | None = None) -> DataFrame:
        """Rows whose key the store hasn't; with retry, a condition on the store's rows, also those whose row meets it."""
        key = key or self.key
        if retry:
            held = self.table().where(f"NOT coalesce({retry}, false)")
        else:
            held = self.versions()
        return rows.join(held.select(F.col(self.key).alias("__held")), F.col(key) == F.col("__held"), "left_anti")

    def upsert(self, rows: DataFrame) -> None:
        """Adds rows, which replace older ones of their keys. Of rows that share a key the least stays; rows without a key go."""
        top = self.versions().agg(F.max(VERSION)).first()[0]
        given = rows.select(*self.columns).where(F.col(self.key).isNotNull())
        one = given.groupBy(self.key).agg(F.min(F.struct(*self.columns)).alias("r")).select(*[F.col(f"r.`{c}`").alias(c) for c in self.columns])
        self._append(one.withColumn(VERSION, F.lit(0 if top is None else top + 1).cast("long")), self.name)

    def cached(self, rows: DataFrame, make: Callable[[DataFrame], DataFrame], retry: str | None = None) -> DataFrame:
        """The store's rows for the keys of rows, after make() has made those that are missing; make gives rows of the store, errors included."""
        asked = rows.select(self.key).distinct().checkpoint()  # rows may depend on what the store has now
        self.upsert(make(self.missing(rows, retry=retry)))
        return self.table().join(asked, self.key, "left_semi")

    def compact(self) -> None:
        """Current rows as a new generation, and older ones removed once it is whole."""
        old, new = self.generation, self.generation + 1
        if self._fs.exists(self._path(f"{self.path}/gen={new}")):  # a compaction that was cut off
            self._fs.delete(self._path(f"{self.path}/gen={new}"), True)
        self._append(self.table().withColumn(VERSION, F.lit(0).cast("long")), self._declare(new))
        self._fs.create(self._path(f"{self.path}/gen={new}/_WHOLE")).close()
        self._open(new)
        for g in range(old + 1):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(g)}")
            self._fs.delete(self._path(f"{self.path}/gen={g}"), True)
