"""Text of office files and books by the standard library; PDF, old e-books and images by plug-ins.

extract(kind, name, content) gives (text, stats). A plug-in is a function bytes -> (text, stats) registered for a
kind; kinds without one give no text and say so in their stats.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import predicates, scripts
from ..operators import unify
from .files import decoded

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"

PLUGINS: dict[str, Callable[[bytes], tuple[str, dict[str, str]]]] = {}


def _zip(content: bytes) -> zipfile.ZipFile:
    return zipfile.ZipFile(io.BytesIO(content))


def _number(name: str) -> int:
    return int((re.findall(r"(\d+)\.xml$", name) or ["0"])[0])


def docx(content: bytes) -> tuple[str, dict[str, str]]:
    """Paragraphs, then tables as [TABLE] rows with cells between bars."""
    body = ET.fromstring(_zip(content).read("word/document.xml")).find(f"{W}body")
    words = lambda p: "".join(t.text or "" for t in p.iter(f"{W}t"))
    lines = [words(p) for p in body.findall(f"{W}p")]
    tables = list(body.iter(f"{W}tbl"))
    for t in tables:
        lines += ["[TABLE] " + " | ".join(" ".join(filter(None, map(words, c.findall(f"{W}p")))) for c in row.findall(f"{W}tc")) for row in t.findall(f"{W}tr")]
    return "\n".join(x for x in lines if x.strip()), {"paragraphs": str(len(body.findall(f"{W}p"))), "tables": str(len(tables))}


def pptx(content: bytes) -> tuple[str, dict[str, str]]:
    """Text of each slide under its number."""
    z = _zip(content)
    slides = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=_number)
    out = []
    for i, n in enumerate(slides, 1):
        paras = ["".join(t.text or "" for t in p.iter(f"{A}t")) for p in ET.fromstring(z.read(n)).iter(f"{A}p")]
        out += [f"=== Slide {i} ===", *[p for p in paras if p.strip()]]
    return "\n".join(out), {"slides": str(len(slides))}


def xlsx(content: bytes) -> tuple[str, dict[str, str]]:
    """Rows of each sheet under its name, filled cells between tabs."""
    z = _zip(content)
    strings = ["".join(t.text or "" for t in si.iter(f"{S}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{S}si")] if "xl/sharedStrings.xml" in z.namelist() else []
    names = [s.get("name") for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{S}sheet")]
    sheets = sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=_number)
    out = []
    for name, n in zip(names, sheets):
        out.append(f"=== {name} ===")
        for row in ET.fromstring(z.read(n)).iter(f"{S}row"):
            cells = []
            for c in row.iter(f"{S}c"):
                v = c.find(f"{S}v")
                value = "".join(t.text or "" for t in c.iter(f"{S}t")) if c.get("t") == "inlineStr" else strings[int(v.text)] if v is not None and c.get("t") == "s" else v.text if v is not None else None
                if value:
                    cells.append(value)
            if cells:
                out.append("\t".join(cells))
    return "\n".join(out), {"sheets": str(len(sheets))}


class _Text(HTMLParser):
    def __init__(self):
        super().__init__()
        self.off, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "nav", "footer", "header")

    def handle_endtag(self, tag):
        self.off = max(0, self.off - (tag in ("script", "style", "nav", "footer", "header")))

    def handle_data(self, data):
        if not self.off:
            self.parts.append(data)


def html(content: bytes) -> tuple[str, dict[str, str]]:
    """Lines that are not blank, page furniture left out."""
    p = _Text()
    p.feed(decoded(content) or "")
    lines = [s for part in p.parts for x in part.split("\n") if (s := x.strip())]
    return "\n".join(lines), {}


def epub(content: bytes) -> tuple[str, dict[str, str]]:
    """The pages of a book in the order of its spine, or of their names."""
    z = _zip(content)
    pages = sorted(n for n in z.namelist() if n.lower().endswith((".xhtml", ".html", ".htm")))
    if opf := next((n for n in z.namelist() if n.endswith(".opf")), None):
        root, base = ET.fromstring(z.read(opf)), opf.rpartition("/")[0]
        local = lambda e: e.tag.rpartition("}")[2]
        href = {e.get("id"): e.get("href") for e in root.iter() if local(e) == "item"}
        spine = [f"{base}/{href[e.get('idref')]}".lstrip("/") for e in root.iter() if local(e) == "itemref" and e.get("idref") in href]
        pages = [n for n in spine if n in z.namelist()] or pages
    return "\n\n".join(html(z.read(n))[0] for n in pages), {"chapters": str(len(pages))}


def fb2(content: bytes) -> tuple[str, dict[str, str]]:
    """The paragraphs of a book's bodies."""
    root = ET.fromstring(content)
    local = lambda e: e.tag.rpartition("}")[2]
    paras = ["".join(p.itertext()).strip() for b in root if local(b) == "body" for p in b.iter() if local(p) in ("p", "v", "subtitle")]
    return "\n".join(p for p in paras if p), {"paragraphs": str(len(paras))}


def plain(content: bytes) -> tuple[str, dict[str, str]]:
    return decoded(content) or "", {}


BUILT_IN = {"text": plain, "html": html, "docx": docx, "pptx": pptx, "xlsx": xlsx}


def extract(kind: str, name: str, content: bytes) -> tuple[str, dict[str, str]]:
    """The text of a file and what its extractor says about it; a file that can't be read gives an error in its stats."""
    found = PLUGINS.get(kind) or BUILT_IN.get(kind) or (fb2 if name.lower().endswith(".fb2") else epub if kind == "ebook" else None)
    if found is None:
        return "", {"error": f"no extractor for {kind}"}
    try:
        return found(content)
    except (zipfile.BadZipFile, ET.ParseError, KeyError, IndexError, ValueError, OSError, AttributeError) as e:
        return "", {"error": f"{type(e).__name__}: {e}"[:200]}


def documents(files: DataFrame, root: str, site: str, default_language: str = "unknown", most: int = 100 << 20, least: int = 100) -> DataFrame:
    """Document records of files (path, extension, kind, length, content), and why a file was left out: too_large, empty or short."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [extract(k, p, c) if n <= most else ("", {"error": "too large"}) for k, p, n, c in zip(f["kind"], f["path"], f["length"], f["content"])]
            yield pd.DataFrame({"path": f["path"], "extension": f["extension"], "kind": f["kind"], "length": f["length"], "raw": [r[0] for r in rows], "extraction_stats": [r[1] for r in rows]})

    made = files.select("path", "extension", "kind", "length", "content").mapInPandas(run, "path string, extension string, kind string, length long, raw string, extraction_stats map<string,string>")
    inside = F.regexp_replace(F.substring("path", F.lit(len(root) + 1), F.length("path")), "^/+", "")
    stem = F.regexp_replace(F.regexp_extract("path", "([^/!]+)$", 1), r"\.[^.]*$", "")
    c = F.col("content")
    words = X.words(F.lower(c))
    out = made.withColumn("content", X.without_boilerplate("raw")).withColumn("m", unify.file_fields(stem))
    reason = F.when(F.col("length") > most, "too_large").when(c == "", "empty").when(F.length(c) < least, "short")
    return out.select(
        F.col("path").alias("url"), F.col("m.title").alias("title"), "content", X.excerpt("content").alias("excerpt"), F.lit(None).cast("string").alias("date"), F.col("m.author").alias("author"),
        unify.rubric(inside).alias("category"), F.lit(site).alias("site"), X.sha("content").alias("hash"), scripts.script("content", default_language).alias("language"), F.lit("document").alias("source_type"),
        stem.alias("file_name"), F.col("extension").alias("file_type"), F.length("content").cast("long").alias("text_length"), F.round(F.col("length") / 1024, 2).alias("file_size_kb"), "extraction_stats",
        F.struct(
            F.round(F.length("content") / F.lit(1.0), 1).alias("chars_per_page"), F.size(words).cast("long").alias("words_count"), X.unique_word_ratio("content").alias("unique_words_ratio"),
            predicates.is_garbage("content").alias("has_garbage"), X.confidence("content").alias("extraction_confidence"),
        ).alias("quality"),
        reason.alias("skipped"),
    )


def run_statistics(records: DataFrame) -> DataFrame:
    """Files by type and reason for being left out."""
    return records.groupBy("file_type", F.coalesce("skipped", F.lit("kept")).alias("state")).agg(F.count("*").alias("files"), F.sum("text_length").alias("chars"))
