"""The engine's transformations on landed files as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.store import KeyedStore


def read_jsonl_stream(spark: SparkSession, path: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    """New JSON lines under a folder; broken lines are left out."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", per_trigger).json(path)


def first_by_key(stream: DataFrame, key: Column, at: str, within: str = "7 days") -> DataFrame:
    """The first row of each key; a key is forgotten once the watermark has passed it, so state stays bounded."""
    keyed = stream.withColumn("__k", F.sha2(key, 256)).where(F.col("__k").isNotNull()).withWatermark(at, within)
    return keyed.dropDuplicatesWithinWatermark(["__k"]).drop("__k")


def counts_by_window(stream: DataFrame, at: str, group: str, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows by window of event time and group; rows later than `late` are left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, length).alias("w"), group).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), group, "n")


def resume(stream: DataFrame, target: str, checkpoint: str, key: str, buckets: int = 64) -> StreamingQuery:
    """Adds rows whose key the target, a keyed store, doesn't have yet; batches that run again add nothing.

    A batch is shuffled to the store's buckets; the store itself, however large, isn't.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)

    def add(batch: DataFrame, _: int) -> None:
        store = KeyedStore(batch.sparkSession, target, schema, key, buckets)
        store.upsert(store.missing(batch))

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
