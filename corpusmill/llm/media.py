"""Media columns: payloads stored as images in archives, and a data source that reads them back.

Writing: each text's bytes, padded with spaces to a multiple of WIDTH, become an
8-bit grey image of WIDTH columns (PNG, lossless), a member of a ZIP archive
that stores members as they are. Tasks write archives to the shared folder under
a name of the attempt's own and then rename them, so of two attempts of a task,
which write the same bytes, either may win and neither disturbs the other.

Reading: the source plans byte ranges of each archive from the folder's listing
alone; a partition reads the archive's directory, takes the members whose
headers begin in its range, and streams them as Arrow batches. A member that
can't be read or fails its checksum is read again by its offset, alone, a few
times; then it fails the query, or (errors=column) its row tells the error.
"""

from __future__ import annotations

import hashlib
import io
import struct
import time
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import blocks, frugal, scratch

WIDTH, PAD = 192, 32
ARCHIVE_BYTES, ARCHIVE_MEMBERS = 64 << 20, 60_000
SPLIT_BYTES, BATCH_BYTES, TRIES = 8 << 20, 4 << 20, 4
SIGNATURE = b"\x89PNG\r\n\x1a\n"


# --- the image -------------------------------------------------------------------------------------------------


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_image(data: bytes) -> bytes:
    """A grey PNG whose samples are data and its padding; the true size stands in a text chunk."""
    padded = data + bytes([PAD]) * (-len(data) % WIDTH or (0 if data else WIDTH))
    rows = np.frombuffer(padded, np.uint8).reshape(-1, WIDTH)
    lines = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1).tobytes()
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"tEXt", b"bytes\0%d" % len(data)) + _chunk(b"IDAT", zlib.compress(lines, 6)) + _chunk(b"IEND", b"")


def from_image(image: bytes) -> tuple[bytes, int]:
    """(samples, bytes without padding) of an image of to_image()."""
    if not image.startswith(SIGNATURE):
        raise ValueError("not a PNG")
    at, size, packed, width = 8, 0, b"", 0
    while at < len(image):
        (n,), kind = struct.unpack_from(">I", image, at), image[at + 4 : at + 8]
        data = image[at + 8 : at + 8 + n]
        if zlib.crc32(kind + data) != struct.unpack_from(">I", image, at + 8 + n)[0]:
            raise ValueError(f"chunk {kind!r} is damaged")
        if kind == b"IHDR":
            width = struct.unpack_from(">I", data)[0]
        elif kind == b"tEXt" and data.startswith(b"bytes\0"):
            size = int(data[6:])
        elif kind == b"IDAT":
            packed += data
        at += 12 + n
    return np.frombuffer(zlib.decompress(packed), np.uint8).reshape(-1, width + 1)[:, 1:].tobytes(), size


def feature(samples: bytes) -> str:
    """Mean, deviation, and a 64-bit average hash over 64 equal parts of the samples."""
    x = np.frombuffer(samples, np.uint8)
    cuts = np.arange(64) * len(x) // 64
    sums, sizes = np.add.reduceat(x, cuts, dtype=np.int64), np.diff(np.append(cuts, len(x)))
    bits = sums * len(x) > x.sum(dtype=np.int64) * sizes
    return f"{x.mean():.4f}:{x.std():.4f}:{int(''.join('01'[b] for b in bits.tolist()), 2):016x}"


# --- archives --------------------------------------------------------------------------------------------------


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class ArchiveWriter:
    """A ZIP file of stored members, appended one after the other."""

    def __init__(self, store: fs.FileSystem, path: str, attempt: int = 0):
        self.store, self.path, self.part = store, path, f"{path}.{attempt}.part"
        self.out, self.at, self.directory, self.members = store.open_output_stream(self.part), 0, io.BytesIO(), 0

    def add(self, name: str, data: bytes) -> None:
        raw, crc = name.encode(), zlib.crc32(data)
        common = struct.pack("<HHHHHIIIHH", 20, 0, 0, 0, 33, crc, len(data), len(data), len(raw), 0)
        self.directory.write(b"PK\x01\x02" + struct.pack("<H", 20) + common + struct.pack("<HHHII", 0, 0, 0, 0, self.at) + raw)
        self.out.write(b"PK\x03\x04" + common + raw)
        self.out.write(data)
        self.at += 30 + len(raw) + len(data)
        self.members += 1

    def close(self) -> None:
        directory = self.directory.getvalue()
        self.out.write(directory + b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, self.members, self.members, len(directory), self.at, 0))
        self.out.close()
        self.store.move(self.part, self.path)


def write_archives(docs: DataFrame, folder: str) -> int:
    """Stores every document's text under folder; a member is named doc_id/row.png. Returns how many members there are."""
    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)
    df = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        store, root = filesystem(folder)
        frugal()
        task = TaskContext.get()
        part, k, row, writer = task.partitionId(), 0, 0, None
        for batch in batches:
            for some in blocks(batch, "text"):
                for doc_id, text in zip(*(c.to_pylist() for c in some.columns)):
                    if writer is None:
                        writer, k = ArchiveWriter(store, f"{root}/part-{part:06d}-{k:04d}.zip", task.taskAttemptId()), k + 1
                    writer.add(f"{'null' if doc_id is None else doc_id}/{row}.png", to_image(text.encode()))
                    row += 1
                    if writer.at >= ARCHIVE_BYTES or writer.members >= ARCHIVE_MEMBERS:
                        writer.close()
                        writer = None
        if writer is not None:
            writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64())], names=["members"])

    return df.mapInArrow(run, "members long").agg(F.sum("members")).first()[0] or 0


def _end(file, size: int) -> tuple[int, int, int]:
    """(members, where the directory begins, its size)."""
    if size < 22:
        raise ValueError("no archive")
    file.seek(size - 22)
    end = file.read(22)
    if end[:4] != b"PK\x05\x06":
        raise ValueError("the archive has no end record")
    _, _, _, members, n, at, _ = struct.unpack("<HHHHIIH", end[4:])
    return members, at, n


def _directory(file, size: int) -> list[tuple[int, int, int, str]]:
    """(offset, size, crc, name) of every member."""
    members, at, n = _end(file, size)
    file.seek(at)
    raw, pos, out = file.read(n), 0, []
    for _ in range(members):
        crc, size, _, name, extra, note, _, _, _, offset = struct.unpack_from("<IIIHHHHHII", raw, pos + 16)
        out.append((offset, size, crc, raw[pos + 46 : pos + 46 + name].decode()))
        pos += 46 + name + extra + note
    return out


class ByteRange(InputPartition):
    def __init__(self, archive: str, size: int, lo: int, hi: int):
        super().__init__(None)
        self.archive, self.size, self.lo, self.hi = archive, size, lo, hi


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.tries = int(options.get("tries", TRIES))
        self.keep_errors = options.get("errors", "fail") == "column"

    def partitions(self) -> list[ByteRange]:
        store, root = filesystem(self.folder)
        out = []
        for f in sorted(store.get_file_info(fs.FileSelector(root)), key=lambda f: f.path):
            if f.path.endswith(".zip"):
                n = max(1, -(-f.size // self.split))
                out += [ByteRange(f.path, f.size, f.size * i // n, f.size * (i + 1) // n) for i in range(n)]
        return out or [ByteRange("", 0, 0, 0)]

    def _fetch(self, store, path: str, offset: int, size: int, crc: int) -> bytes:
        """One member by its offset, with a handle of its own on each new try."""
        for k in range(self.tries):
            try:
                with store.open_input_file(path) as file:
                    file.seek(offset)
                    head = file.read(30)
                    name, extra = struct.unpack_from("<HH", head, 26)
                    file.seek(offset + 30 + name + extra)
                    data = file.read(size)
                if len(data) != size or zlib.crc32(data) != crc:
                    raise ValueError(f"{path}: the member at {offset} is damaged")
                return data
            except (OSError, ValueError, struct.error):
                if k + 1 == self.tries:
                    raise
                time.sleep(0.05 * 2**k)
        raise ValueError("tries must be 1 or more")

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        store, _ = filesystem(self.folder)
        with store.open_input_file(partition.archive) as file:
            mine = sorted(m for m in _directory(file, partition.size) if partition.lo <= m[0] < partition.hi)
            rows, held = [], 0
            for offset, size, crc, name in mine:
                data, error = None, None
                file.seek(offset)
                raw = file.read(30 + len(name.encode()) + size)[-size:] if size else b""
                if len(raw) == size and zlib.crc32(raw) == crc:
                    data = raw
                else:
                    try:
                        data = self._fetch(store, partition.archive, offset, size, crc)
                    except (OSError, ValueError, struct.error) as e:
                        if not self.keep_errors:
                            raise
                        error = str(e)
                rows.append((partition.archive, name, offset, data, error))
                held += size
                if held >= BATCH_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


FIELDS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("at", pa.int64()), ("media", pa.binary()), ("error", pa.string())])


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), FIELDS)], schema=FIELDS)


class ArchiveSource(DataSource):
    """spark.read.format("media_archives"): archive, member, at (its offset), media (its bytes), error."""

    @classmethod
    def name(cls) -> str:
        return "media_archives"

    def schema(self) -> str:
        return "archive string, member string, at long, media binary, error string"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader({k.lower(): v for k, v in self.options.items()})


def read_archives(spark: SparkSession, folder: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format("media_archives").option("path", folder)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def features(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature of stored members."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        for batch in batches:
            rows = []
            for member, media in zip(*(c.to_pylist() for c in batch.columns)):
                samples, n = from_image(media)
                doc_id = member.split("/")[0]
                rows.append((None if doc_id == "null" else int(doc_id), n, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return media.select("member", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def store_and_describe(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Stores every document (null text: empty) and returns features() of what is read back. Repeated rows are stored each."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "media")
    write_archives(docs, folder)
    return features(read_archives(spark, folder))
