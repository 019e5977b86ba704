"""One schema for records of all sources, and their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, VariantType

from ..functions.text import col, first_filled, strip

CORPUS = ["url", "title", "content", "author", "date", "category", "source_type", "language"]
#: The order in which sources win over one another.
RANKS = {"news": 0, "social": 1, "wiki": 2, "document": 3}


def first_of(c: Column, kind: DataType) -> Column:
    """A value as a string; of a list the first, null of an empty one. A variant may hold either."""
    if isinstance(kind, ArrayType):
        return F.get(c, F.lit(0)).cast("string")
    if isinstance(kind, VariantType):
        one, first = (F.try_variant_get(c, p, "string") for p in ("$", "$[0]"))
        return F.when(F.schema_of_variant(c).startswith("ARRAY"), first).otherwise(one)
    return c.cast("string")


def unify(df: DataFrame, source_type: Column | str, language: Column | None = None) -> DataFrame:
    """The corpus columns from whichever of the usual fields a source has; a list of categories gives its first."""
    have = set(df.columns)

    def pick(*names: str) -> Column:
        found = [F.col(n).cast("string") for n in names if n in have]
        return first_filled(*found) if found else F.lit(None).cast("string")

    category = first_of(F.col("category"), df.schema["category"].dataType) if "category" in have else F.lit(None).cast("string")
    lang = first_filled(language, pick("language", "default_language")) if language is not None else pick("language", "default_language")
    return df.select(
        *[c for c in ("seq",) if c in have],
        pick("url", "video_url").alias("url"),
        strip(F.coalesce(pick("title"), F.lit(""))).alias("title"),
        strip(F.coalesce(pick("content", "text"), F.lit(""))).alias("content"),
        pick("author", "author_id", "from_id").alias("author"),
        pick("date", "published", "scraped_at").alias("date"),
        category.alias("category"),
        (F.lit(source_type) if isinstance(source_type, str) else source_type).alias("source_type"),
        lang.alias("language"),
    )


def wiki(df: DataFrame, language: Column | None = None) -> DataFrame:
    """Rows of an encyclopedia: the text is the content, the first of the categories the category; language fills one that is missing."""
    named = df.drop("category", "content").withColumnsRenamed({"text": "content", "categories": "category"})
    out = unify(named, "wiki")
    return out.withColumn("language", first_filled("language", language)) if language is not None else out


def corpus(parts: dict[str, DataFrame]) -> DataFrame:
    """Unified rows of {source: rows with seq}, with source_rank."""
    ranked = [df.withColumn("source_rank", F.lit(RANKS[k])) for k, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), ranked)


def rutube_fields(content: Column | str, author: Column | str) -> Column:
    """struct(author, content): without an author the first line is the author and, of three lines or more, the rest from the third the content."""
    c = col(content)
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: strip(x)), lambda x: x != "")
    missing = first_filled(author).isNull()
    head = F.nullif(strip(F.get(F.split(c, "\n"), F.lit(0))), F.lit(""))
    body = F.when(missing & (F.size(lines) >= 3), F.array_join(F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(1))), "\n")).otherwise(c)
    return F.struct(F.coalesce(first_filled(author), F.when(missing, head)).alias("author"), body.alias("content"))


def wall_url(owner: Column | str, post: Column | str) -> Column:
    return F.concat(F.lit("https://vk.com/wall"), F.coalesce(col(owner).cast("string"), F.lit("0")), F.lit("_"), col(post).cast("string"))


def file_fields(stem: Column | str, separators: tuple[str, ...] = ("_", " - ", "-"), author_first: bool = True) -> Column:
    """struct(author, title) of a file name: the first separator that occurs parts it once."""
    s, out = col(stem), None
    for sep in separators:
        at = F.locate(sep, s)
        parts = (F.trim(F.substring(s, F.lit(1), at - 1)), F.trim(F.substring(s, at + len(sep), F.length(s))))
        author, title = parts if author_first else parts[::-1]
        both = F.struct(author.alias("author"), title.alias("title"))
        out = F.when(at > 0, both) if out is None else out.when(at > 0, both)
    return out.otherwise(F.struct(F.lit(None).cast("string").alias("author"), s.alias("title")))


def rubric(relative_path: Column | str, depth: int = 0, ignore_root: bool = True) -> Column:
    """The directory at a depth of a relative path; null for files in the root."""
    parts = F.split(col(relative_path), "/")
    name = F.when(F.size(parts) - 1 > depth, F.get(parts, F.lit(depth)))
    return name if ignore_root else F.coalesce(name, F.lit(""))


def with_fallback(extracted: DataFrame, found: DataFrame, key: str = "url", fields: tuple[str, ...] = ("title", "content", "date", "author", "category", "time")) -> DataFrame:
    """Discovered rows with extracted fields where those are filled, else their own."""
    theirs = extracted.select(key, *[F.col(f).alias(f"__{f}") for f in fields])
    joined = found.join(theirs, key, "left")
    return joined.withColumns({f: first_filled(f"__{f}", f) for f in fields}).drop(*[f"__{f}" for f in fields])
