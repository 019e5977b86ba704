"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python worker handles at once, whatever the size of the Arrow batch.
BLOCK_BYTES = 3 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a local session gets a folder under its warehouse; a cluster must name one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints/{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(found)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What is made and run inside has its shuffle files removed when it ends.

    Else they stay until the driver happens to collect its garbage; with many partitions, small files of many rounds
    then fill disks.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint; rows are computed once and then only read."""
    shared_dir(df.sparkSession)
    with tidy(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # select: what a plan leaves behind is settled when it is made


def scratch(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file, on whichever machine asks."""
    if folder := os.environ.get("CORPUSMILL_TOKENIZERS"):
        return os.path.join(folder, name)
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join("/opt/tokenizers", name)
    return public_tokenizers.path(name)


def over_batches(df: DataFrame, fn: Callable[[dict[str, list], int], dict[str, object] | None], schema: pa.Schema, ddl: str, text: str | None = "text", size: int = BLOCK_BYTES) -> DataFrame:
    """mapInArrow that hands fn blocks of bounded size as {column: pa.Array} and takes back columns of any length."""
    names = df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for part in blocks(batch, text, size):
                out = fn({n: part.column(i) for i, n in enumerate(names)}, part.num_rows)
                if out is not None:
                    made = pa.RecordBatch.from_arrays([out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in schema], schema=schema)
                    if made.num_rows:
                        yield made
        trim()

    return df.mapInArrow(run, ddl)


def blocks(batch: pa.RecordBatch, text: str | None, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `size` bytes of text each; a longer row stands alone."""
    if text is None or text not in batch.schema.names or not batch.num_rows:
        yield batch
        return
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(sizes + 64)])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def share(seed: str, limit: float, total: int, *cols: str):
    """A condition that keeps about `limit` of `total` rows, chosen by a hash of cols, the same rows at each evaluation."""
    parts = 1 << 30
    keep = parts if total <= limit else int(parts * limit / total)
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(parts)) < keep


_HELD: dict = {}
_SET: list = []


def frugal() -> None:
    """Sets this worker's allocators, once, so that freed blocks go back to the machine: workers outlive their tasks."""
    if not _SET:
        _SET.append(True)
        pa.set_memory_pool(pa.system_memory_pool())
        with contextlib.suppress(OSError, AttributeError):
            libc = ctypes.CDLL(None)
            for option, value in ((-3, 1 << 20), (-1, 1 << 20), (-8, 2)):  # where mmap begins, what free space is trimmed, arenas
                libc.mallopt(option, value)


def trim() -> None:
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)  # glibc keeps freed memory otherwise


def sole(key: object, make: Callable[[], object]) -> object:
    """What make() gives for a key, kept in this process until another key is asked for.

    Python workers outlive their tasks; so the memory of one operator goes when the next one starts.
    """
    if key not in _HELD:
        frugal()
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim()
        _HELD[key] = make()
    return _HELD[key]
