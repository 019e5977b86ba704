"""Pages of bzip2 dumps, read by many tasks at once.

A bzip2 file is a row of blocks that begin anywhere in a byte, each with a mark
of 48 bits and its own checksum. A task takes a range of bytes, finds the marks
in it by their inner bytes under all eight shifts, and unpacks each block alone,
as a stream of one block. A page belongs to the range in which its first tag
begins; its task reads on into later blocks until the page ends. A block that
can't be unpacked is read again alone, then tried up to the mark after the next
(a mark may occur in data by chance), and at last reported with its place, while
the other pages of the range go on. A file that doesn't end with the mark of an
end is reported as cut off.
"""

from __future__ import annotations

import bz2
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .folders import filesystem

FORMAT = "bz2_pages"
BLOCK, END = 0x314159265359, 0x177245385090
#: Compressed bytes of a range; a block's at most (900 kB of text can't pack to more).
RANGE_BYTES, BLOCK_BYTES = 16 << 20, 1_200_000
OPEN, CLOSE = b"<page>", b"</page>"


def _inner(mark: int, shift: int) -> bytes:
    """The bytes that a mark fills whole when it begins `shift` bits into a byte."""
    return (mark >> shift & (1 << 40) - 1).to_bytes(5, "big") if shift else mark.to_bytes(6, "big")


MARKS = re.compile(b"|".join(re.escape(_inner(m, s)) for m in (BLOCK, END) for s in range(8)))


def marks(data: bytes) -> list[tuple[int, bool]]:
    """(bit, whether a block begins there) of the marks in bytes."""
    out, at = [], 0
    while (m := MARKS.search(data, at)) is not None:
        at = m.start() + 1
        for first in (m.start() - 1, m.start()):
            if first < 0:
                continue
            window = int.from_bytes(data[first : first + 7].ljust(7, b"\0"), "big")
            for shift in range(8):
                found = window >> (8 - shift) & (1 << 48) - 1
                if found in (BLOCK, END) and 8 * first + shift + 48 <= 8 * len(data):
                    out.append((8 * first + shift, found == BLOCK))
    return sorted(set(out))


def unpacked(data: bytes, start: int, end: int) -> bytes:
    """The text of the block in bits start..end of data, as a stream of its own."""
    bits = int.from_bytes(data[start // 8 : -(-end // 8)], "big") >> (-end % 8) & (1 << end - start) - 1
    crc = bits >> (end - start - 80) & 0xFFFFFFFF
    bits, n = (bits << 80) | END << 32 | crc, end - start + 80
    return bz2.decompress(b"BZh9" + (bits << (-n % 8)).to_bytes(-(-n // 8), "big"))


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    size: int


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.size, self.tries = options["path"].split(","), int(options.get("rangeBytes", RANGE_BYTES)), int(options.get("tries", 3))

    def partitions(self) -> list[Range]:
        out = []
        for p in self.paths:
            store, root = filesystem(p.strip())
            info = store.get_file_info(root)
            found = [info] if info.is_file else [i for i in store.get_file_info(fs.FileSelector(root, recursive=True)) if i.is_file and i.path.endswith(".bz2")]
            prefix = p.strip()[: len(p.strip()) - len(root)] if p.strip().endswith(root) else ""
            out += [Range(prefix + i.path, a, min(a + self.size, i.size), i.size) for i in found for a in range(0, max(i.size, 1), self.size)]
        return out

    def _blocks(self, store: fs.FileSystem, path: str, r: Range) -> Iterator[tuple[int, bytes | None, str | None, bool]]:
        """(bit in the file, text, error, whether it begins in the range) of blocks from the range's first to the file's last."""
        with store.open_input_file(path) as f:
            held, base, end = b"", r.start, r.start
            todo: list[tuple[int, bool]] = []
            while True:
                if len([1 for _, block in todo if block]) < 2 and end < r.size or not todo and end < r.size:  # enough to know where a block ends, and once more
                    at = todo[0][0] // 8 if todo else max(base, end - 8)
                    f.seek(at)
                    held, base = f.read(min(r.size - at, end - at + max(self.size, BLOCK_BYTES))), at
                    end = base + len(held)
                    todo = [(8 * base + b, block) for b, block in marks(held) if 8 * base + b >= (todo[0][0] if todo else 8 * r.start)]
                    if not todo and end >= r.size:
                        return
                    continue
                while todo and not todo[0][1]:
                    todo.pop(0)
                if not todo:
                    if end >= r.size:
                        return
                    continue
                start, rest = todo[0][0], [b for b, _ in todo[1:3]] or [8 * end]
                text = error = None
                for n in range(self.tries):
                    to = rest[min(n, len(rest) - 1)] if n else rest[0]
                    f.seek(start // 8)
                    data = held[start // 8 - base :] if n == 0 else f.read(-(-to // 8) - start // 8)  # again, alone
                    try:
                        text = unpacked(data, start - start // 8 * 8, to - start // 8 * 8)
                        break
                    except (OSError, ValueError, OverflowError) as e:
                        error = f"block at bit {start}: {e}"
                todo = [m for m in todo[1:] if text is None or m[0] >= to]
                yield start, text, None if text is not None else error, start < 8 * r.end

    def read(self, r: Range) -> Iterator[tuple]:
        store, path = filesystem(r.path)
        if r.end == r.size:
            with store.open_input_file(path) as f:
                f.seek(max(0, r.size - 16))
                if not any(not block for _, block in marks(f.read())):
                    yield r.path, None, None, "cut off: the file has no end"
        buffer, own_end, begun = b"", None, 0
        for bit, text, error, own in self._blocks(store, path, r):
            if not own and own_end is None:
                own_end = len(buffer)
                if not self._open(buffer, own_end):
                    return
            if error is not None:
                yield r.path, bit, None, error
                buffer, own_end = b"", None if own else 0  # what the block cut in two can't be had
                if not own:
                    return
                continue
            buffer += text
            at = 0
            while (p := buffer.find(OPEN, at)) >= 0 and (own_end is None or p < own_end) and (z := buffer.find(CLOSE, p)) >= 0:
                yield r.path, bit, buffer[p : z + len(CLOSE)].decode("utf-8", "replace"), None
                at = z + len(CLOSE)
            keep = p if p >= 0 else max(at, len(buffer) - len(OPEN) + 1)
            buffer, own_end = buffer[keep:], None if own_end is None else own_end - keep
            if own_end is not None and not self._open(buffer, own_end):
                return

    @staticmethod
    def _open(buffer: bytes, own_end: int) -> bool:
        """Whether a page that begins before own_end still needs more, or its tag may."""
        p = buffer.find(OPEN)
        return own_end > 0 and (0 <= p < own_end or any(OPEN.startswith(buffer[i:]) for i in range(max(0, len(buffer) - len(OPEN) + 1), min(own_end, len(buffer)))))


class Bz2Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, bit long, page string, error string"

    def reader(self, schema) -> Reader:
        return Reader(self.options)


def read_pages(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, bit, page, error): the XML of each page of a dump or a folder of dumps; where error is filled, what couldn't be read."""
    spark.dataSource.register(Bz2Pages)
    return spark.read.format(FORMAT).option("rangeBytes", range_bytes).load(path)


def articles(pages: DataFrame) -> DataFrame:
    """title, ns, text of pages; rows with an error are left out."""
    found = pages.where(F.col("page").isNotNull()).select(F.from_xml("page", "title string, ns long, revision struct<text:string>").alias("p"))
    return found.select("p.title", "p.ns", F.col("p.revision.text").alias("text"))
