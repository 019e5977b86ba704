"""A sink that writes lines into several folders from one evaluation of its rows.

Rows are (line, folders). Each task writes a file for each folder it meets,
under a staging folder and a name of its own; when all have ended, the driver
takes the files that they report, and no others, and puts the whole in the
target's place. A task that fails or runs twice leaves nothing behind, and an
attempt that fails leaves the old files as they were.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "line_folders"


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]
    lines: int


class FolderWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.run = path.rstrip("/"), overwrite, uuid.uuid4().hex

    def _places(self) -> tuple[fs.FileSystem, str, str]:
        store, root = filesystem(self.path)
        return store, root, f"{root}.staging-{self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, _, staging = self._places()
        attempt, outs, lines = uuid.uuid4().hex, {}, 0
        try:
            for batch in iterator:
                for line, folders in zip(*(batch.column(n).to_pylist() for n in ("line", "folders"))):
                    for folder in dict.fromkeys(folders or ()):
                        if folder not in outs:
                            if ".." in folder.split("/") or folder.startswith("/"):
                                raise ValueError(f"a folder outside the target: {folder}")
                            store.create_dir(f"{staging}/{attempt}/{folder}", recursive=True)
                            outs[folder] = store.open_output_stream(f"{staging}/{attempt}/{folder}/part-{attempt}.jsonl")
                        outs[folder].write(line.encode() + b"\n")
                    lines += 1
        finally:
            for out in outs.values():
                out.close()
        return Written([(f"{attempt}/{f}/part-{attempt}.jsonl", f"{f}/part-{attempt}.jsonl") for f in outs], lines)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root, staging = self._places()
        whole = f"{staging}/whole"
        store.create_dir(whole, recursive=True)
        for m in messages:
            for made, to in m.files if m is not None else ():
                store.create_dir(f"{whole}/{to.rsplit('/', 1)[0]}", recursive=True)
                store.move(f"{staging}/{made}", f"{whole}/{to}")
        old = f"{root}.old-{self.run}"
        there = store.get_file_info(root).type != fs.FileType.NotFound
        if there and not self.overwrite:
            store.delete_dir(staging)
            raise FileExistsError(root)
        if there:
            store.move(root, old)
        try:
            store.move(whole, root)
        except OSError:
            if there:
                store.move(old, root)
            raise
        store.delete_dir(staging)
        if there:
            store.delete_dir(old)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, _, staging = self._places()
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)


class LineFolders(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "line string, folders array<string>"

    def writer(self, schema, overwrite: bool) -> FolderWriter:
        return FolderWriter(self.options["path"], overwrite)


def write_folders(rows: DataFrame, path: str, overwrite: bool = True) -> None:
    """Writes rows (line, folders) under path."""
    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(LineFolders)
    rows.select(F.col("line").cast("string").alias("line"), "folders").write.format(FORMAT).mode("overwrite" if overwrite else "append").save(path)


def write_by_alphabet(df: DataFrame, path: str, column: str = "alphabet") -> None:
    """JSON lines of all rows in all/ and of each alphabet in by_alphabet/<column>=<value>/; `other` and null are in the whole alone."""
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    own = F.when(F.col(column) != "other", F.array(F.lit("all"), F.concat(F.lit(f"by_alphabet/{column}="), F.col(column))))
    write_folders(df.select(line.alias("line"), F.coalesce(own, F.array(F.lit("all"))).alias("folders")), path)
