"""Column builders for text: cleaning, hashing, excerpts, fallbacks, tokens.

All are built-in expressions, so they stay in generated code; normal_form() alone
needs Python where a text is not in NFKC form already.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space and word characters beyond ASCII, alike in Java and RE2 patterns.
WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
W = r"[\p{L}\p{N}_]"
#: The characters of WS one by one, for trimming without a pattern; and runs of WS that are more than one plain space.
WS_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WS_RUN = " *" + WS.replace(r"\s", r"\t-\r") + WS + "*| {2,}"
NOT_W_OR_WS = WS.replace("[", r"[^\p{L}\p{N}_", 1)

# Emoji ranges and boilerplate lines.
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
BOILERPLATE = (r"^© .*$", r"^Все права защищены.*$", r"^All rights reserved.*$", r"^Страница \d+ из \d+$", r"^Page \d+ of \d+$", r"^\s*\d+\s*$")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(c: Column | str) -> Column:
    """White space as single spaces, none at the ends; null becomes the empty string."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), WS_RUN, " "))


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WS_CHARS))


def sha(c: Column | str, length: int | None = 32) -> Column:
    digest = F.sha2(F.coalesce(col(c), F.lit("")), 256)
    return F.substring(digest, 1, length) if length else digest


def record_hash(*parts: Column | str, sep: str = "|") -> Column:
    """The hash of parts joined by sep; a null part counts as empty and keeps its place."""
    pieces = [F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]
    return sha(reduce(lambda a, b: F.concat(a, F.lit(sep), b), pieces))


def excerpt(c: Column | str, n: int = 260) -> Column:
    c = col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def article_excerpt(c: Column | str, n: int = 260) -> Column:
    """As excerpt(), but of squeezed text, and nothing blank stands before the dots."""
    c = squeeze(c)
    return F.when(F.length(c) > n, F.concat(F.regexp_replace(F.substring(c, 1, n), f"{WS}+$", ""), F.lit("..."))).otherwise(c)


def truncate(c: Column | str, n: int) -> Column:
    c = squeeze(c)
    return F.when(F.length(c) > n, F.concat(F.regexp_replace(F.substring(c, 1, n - 1), " +$", ""), F.lit("…"))).otherwise(c)


def first_filled(*cols: Column | str) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols])


def first_text(*cols: Column | str) -> Column:
    """The first that is not blank, as it stands."""
    return F.coalesce(*[F.when(strip(c) != "", col(c)) for c in cols])


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def nfkc(c: Column | str) -> Column:
    """NFKC form. Texts of ASCII and Latin-1 letters are in it already; Python sees a null for them, and no text crosses over."""
    c = col(c)
    other = c.rlike(r"[^\x{00}-\x{9F}\x{A1}-\x{A7}\x{A9}\x{AB}-\x{AE}\x{B0}-\x{B1}\x{B6}-\x{B7}\x{BB}\x{BF}-\x{131}]")
    return F.coalesce(_nfkc(F.when((F.octet_length(c) > F.length(c)) & other, c)), c)


def normal_form(c: Column | str, unicode_form: bool = True) -> Column:
    """What exact duplicates share: NFKC, lower case, single spaces, no punctuation."""
    c = nfkc(c) if unicode_form else col(c)
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), WS_RUN, " "), NOT_W_OR_WS, ""))


def without_emoji(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), EMOJI, ""))


def without_boilerplate(c: Column | str, patterns: tuple[str, ...] = BOILERPLATE) -> Column:
    """Boilerplate lines and tags removed, then squeezed."""
    out = reduce(lambda a, p: F.regexp_replace(a, f"(?m){p}", ""), patterns, F.coalesce(col(c), F.lit("")))
    return squeeze(F.regexp_replace(out, "<[^>]+>", " "))


def tokens(c: Column | str) -> Column:
    """Lower-case runs of word characters."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(f"({W}+)"), F.lit(1))


def name_tokens(c: Column | str) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(col(c)), NOT_W_OR_WS, " "), f"{WS}+"), lambda t: t != "")


def distinct_kept(values: Column | str) -> Column:
    """Distinct values in order, nulls and empty strings left out."""
    return F.array_distinct(F.filter(col(values), lambda v: v.isNotNull() & (v != "")))


def words(c: Column | str) -> Column:
    """Parts between white space."""
    return F.filter(F.split(col(c), f"{WS}+"), lambda t: t != "")


def unique_word_ratio(c: Column | str) -> Column:
    w = words(F.lower(col(c)))
    return F.round(F.size(F.array_distinct(w)) / F.greatest(F.size(w), F.lit(1)), 3)


def snippet(c: Column | str, n: int = 500) -> Column:
    """The start of a text on one line, for detectors."""
    return F.regexp_replace(F.replace(F.substring(col(c), 1, n), F.lit("\n"), F.lit(" ")), "^ +| +$", "")


def share(part: Column, whole: Column) -> Column:
    """A ratio, null where the denominator is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def confidence(text: Column | str, ocr: Column | None = None) -> Column:
    """high, medium or low by the mean confidence of recognition, else by length."""
    c = F.length(F.coalesce(col(text), F.lit("")))
    plain = F.when(c >= 500, "high").otherwise("medium")
    if ocr is None:
        return plain
    return F.when(ocr.isNull(), plain).when(ocr >= 0.85, "high").when(ocr >= 0.6, "medium").otherwise("low")
