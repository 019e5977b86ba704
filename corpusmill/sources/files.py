"""Sources and sinks on files: JSONL, wiki XML, CSV, binary folders, archives; and the shared checkpoint folder."""

from __future__ import annotations

import bz2
import gzip
import io
import tarfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Encodings in the order in which they are tried, extractor types by extension.
ENCODINGS = ("utf-8", "utf-8-sig", "windows-1251", "cp1251", "koi8-r", "cp866", "maccyrillic", "latin-1", "iso-8859-1")
EXTRACTORS = {"txt": "text", "md": "text", "html": "html", "htm": "html", "json": "text", "csv": "text", "pdf": "pdf", "docx": "docx", "pptx": "pptx", "xlsx": "xlsx", "epub": "ebook", "fb2": "ebook", "png": "image", "jpg": "image", "jpeg": "image"}
#: Where collected rows of a kind lie under a folder, their files' names, and whether folders inside count.
COLLECTED = {
    "news": ("news", "*.jsonl", True), "posts": ("social/posts", "vk_*.jsonl", False), "comments": ("social/comments", "vk_*.jsonl", False), "rutube": ("social", "rutube_*.jsonl", False),
    "telegram": ("social", "telegram_*.jsonl", False), "wiki": ("wiki", "*_all.jsonl", True), "documents": ("documents", "*.jsonl", False),
}
ARCHIVES = ("zip", "tar", "gz", "bz2", "tgz")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder: what spark.checkpoint.dir names; a local session without it gets one under its
    warehouse, and a cluster must name one."""
    if not (found := spark.sparkContext.getCheckpointDir()):
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = found or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints/{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(found)
    return found


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str, glob: str | None = None, recursive: bool = False, place: str | None = None) -> DataFrame:
    """Rows of JSON lines; blank and broken lines are left out; a missing path gives no rows.

    place: the name of a column struct(file, block, row) that orders rows as they stand in the files, files by path. A
    block of a file is read whole by one task, so rows of a block compare by the number that the task gives them,
    whatever task it is, and blocks of a file by where they begin.
    """
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        rows, m = reader.json(path), F.col("_metadata")
        return rows.withColumn(place, F.struct(m["file_path"].alias("file"), m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"))) if place else rows
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, `{place}` struct<file:string,block:bigint,row:bigint>" if place else schema)


def file_name() -> Column:
    return F.col("_metadata.file_name")


def wiki_language(name: Column) -> Column:
    """The language of a wiki file: what stands before the first hyphen, without `wiki`."""
    return F.lower(F.replace(F.get(F.split(name, "-"), F.lit(0)), F.lit("wiki"), F.lit("")))


def vk_domain(name: Column) -> Column:
    """The community of a posts file."""
    return F.replace(F.replace(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit("_posts"), F.lit("")), F.lit("vk_"), F.lit(""))


def read_wiki(spark: SparkSession, path: str) -> DataFrame:
    """title, ns, text of the pages of an XML dump, compressed or not; files are split between tasks by Spark."""
    schema = "title string, ns long, revision struct<text:string>"
    raw = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return raw.select("title", "ns", F.col("revision.text").alias("text"))


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """path, extension, kind, content of the files of a tree; hidden files and folders and unknown extensions are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    kinds = F.create_map(*[F.lit(x) for kv in (EXTRACTORS | dict.fromkeys(ARCHIVES, "archive")).items() for x in kv])
    inside = F.substring(F.col("path"), F.length(F.lit(path)) + 1, F.length("path"))
    return files.withColumn("extension", ext).withColumn("kind", F.try_element_at(kinds, ext)).where(F.col("kind").isNotNull() & ~inside.rlike(r"(^|/)\.")).select("path", "extension", "kind", "length", "content")


def decoded(content: bytes | None, encodings: tuple[str, ...] = ENCODINGS) -> str | None:
    """Text by the first encoding that fits."""
    if content is None:
        return None
    for e in encodings:
        try:
            return content.decode(e)
        except (UnicodeDecodeError, UnicodeError):
            continue
    return content.decode("utf-8", "replace")


def decode_text(c: Column | str) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(decoded)

    return run(c)


#: The most bytes of a file in an archive, and the most files that are taken out of one archive.
MOST_BYTES, MOST_FILES = 100 << 20, 100_000


def members(name: str, content: bytes, depth: int = 3, most: int = MOST_BYTES, count: int = MOST_FILES) -> Iterator[tuple[str, bytes | None, str | None]]:
    """(path, content, why not) of the files in an archive, archives inside included down to a depth.

    Files are read in turn, and never more than `most` bytes of one, whatever its header says. What is left out comes
    without content and with the reason: names that leave the archive, files over `most` bytes, files after the first
    `count`, archives below the depth, and an archive that breaks off.
    """
    try:
        for i, (n, open_) in enumerate(_entries(name, content)):
            if i >= count:
                yield n, None, f"over {count} files"
                return
            if n.startswith(("/", "\\")) or ".." in n.replace("\\", "/").split("/") or ":" in n:
                yield n, None, "outside the archive"
                continue
            with open_() as f:
                data = f.read(most + 1)
            if len(data) > most:
                yield n, None, f"over {most} bytes"
            elif n.lower().rsplit(".", 1)[-1] not in ARCHIVES:
                yield n, data, None
            elif depth > 1:
                yield from ((f"{n}!{inner}", d, why) for inner, d, why in members(n, data, depth - 1, most, count))
            else:
                yield n, None, "too deep"
    except (zipfile.BadZipFile, tarfile.TarError, OSError, EOFError, zlib.error, RuntimeError, NotImplementedError) as e:
        yield name, None, f"broken: {e}"


def _entries(name: str, content: bytes) -> Iterator[tuple[str, Callable]]:
    """(name, opener) of an archive's files."""
    low = name.lower()
    if low.endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            yield from ((i.filename, lambda i=i: z.open(i)) for i in z.infolist() if not i.is_dir())
    elif low.endswith((".tar", ".tgz", ".tar.gz", ".tar.bz2")):
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            yield from ((m.name, lambda m=m: t.extractfile(m)) for m in t if m.isfile())
    elif low.endswith((".gz", ".bz2")):
        yield name.rsplit("/", 1)[-1].rsplit(".", 1)[0], lambda: (gzip if low.endswith(".gz") else bz2).open(io.BytesIO(content))


def expand_archives(files: DataFrame, left_out: bool = False) -> DataFrame:
    """Files with archives replaced by their members, path archive!member. left_out: only what was left out, (path, reason)."""
    names = ["path", "extension", "kind", "length", "content"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                for name, data, why in members(path, content):  # one file at a time
                    ext = name.lower().rsplit(".", 1)[-1]
                    if left_out and why:
                        yield pd.DataFrame([(f"{path}!{name}", why)], columns=["path", "reason"])
                    elif not left_out and data is not None and ext in EXTRACTORS:
                        yield pd.DataFrame([(f"{path}!{name}", ext, EXTRACTORS[ext], len(data), data)], columns=names)

    archives = files.where(F.col("kind") == "archive").select(*names)
    if left_out:
        return archives.mapInPandas(run, "path string, reason string")
    return files.where(F.col("kind") != "archive").select(*names).unionByName(archives.mapInPandas(run, "path string, extension string, kind string, length long, content binary"))


# --- sinks -----------------------------------------------------------------------------------------------------


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with nulls written out."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_table(df: DataFrame, path: str, keep: bool = False, force: bool = False) -> None:
    """CSV with a header. keep: an existing table stays as it is; else it is replaced only with force."""
    df.write.mode("ignore" if keep else "overwrite" if force else "error").option("header", "true").csv(path)


def write_items(df: DataFrame, path: str, most: int = 10_000) -> None:
    """One JSON document {"items": [...]} of a small table; a larger one is refused, JSON lines are the format for those."""
    if (n := df.limit(most + 1).count()) > most:
        raise ValueError(f"{n} rows or more are too many for one document; use write_jsonl")
    items = F.to_json(F.struct(F.collect_list(F.struct(*df.columns)).alias("items")), {"ignoreNullFields": "false"})
    df.coalesce(1).agg(items.alias("value")).write.mode("overwrite").text(path)


def file_statistics(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """file, lines, kb of the text files of a tree."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("size"))
    return lines.groupBy("file").agg(F.count("*").alias("lines"), F.round(F.max("size") / 1024, 1).alias("kb"))


def output_name(site: str, day: str, what: str = "articles") -> str:
    """The name under which a site's rows of a day are kept."""
    return f"{site}_{day}_{what}.jsonl"


def corpus_name(language: str, stamp: str) -> str:
    """The name of a corpus of a language built at a time, YYYYMMDD_HHMMSS."""
    return f"corpus_{language}_{stamp}.jsonl"
