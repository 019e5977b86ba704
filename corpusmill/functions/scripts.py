"""Column builders for alphabets: script shares, letter rules, transliteration."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Letters of the two classifiers, required and forbidden letters by language, Tatar Latin.
CYRILLIC = "а-яёәөүҗңһӣғқҳҷӯ"
CYRILLIC_PLAIN = "а-яёәөүҗңһӣғқҳ"
LETTER_RULES = {
    "tg": ("ғқӣӯҳҷ", "цщыь"),
    "os": ("æÆ", ""),
    "udm": ("ӟӝӥӧӵ", ""),
    "ba": ("ғҙҡөҫүһә", ""),
    "tt": ("әҗңөүһ", ""),
}
DIGRAPHS = {
    "ng": "ң", "NG": "Ң", "Ng": "Ң", "iy": "ый", "İY": "ЫЙ", "Iy": "Ый",
    "ya": "я", "YA": "Я", "Ya": "Я", "yo": "ё", "YO": "Ё", "Yo": "Ё",
    "yu": "ю", "YU": "Ю", "Yu": "Ю", "ye": "е", "YE": "Е", "Ye": "Е",
    "ch": "ч", "CH": "Ч", "Ch": "Ч", "sh": "ш", "SH": "Ш", "Sh": "Ш",
    "ts": "ц", "TS": "Ц", "Ts": "Ц",
}
LATIN = "abcdefghijklmnopqrstuvwxyzäəçğöşüıñABCDEFGHIJKLMNOPQRSTUVWXYZÄƏÇĞÖŞÜÑ"
TATAR = "абцдефгхиҗклмнопкрстуввхйзәәчгөшүыңАБЦДЕФГХИҖКЛМНОПКРСТУВВХЙЗӘӘЧГӨШҮҢ"


def spelled(letters: str) -> str:
    """The letters of a class one by one: `a-d` as `abcd`."""
    return re.sub("(.)-(.)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), letters)


def count_of(c: Column, letters: str) -> Column:
    """How many characters of a class a text has: what goes when they are translated to nothing.

    A look into a table for each character. A pattern tries the parts of a class beyond Latin-1 in turn, which costs some
    twenty times as much.
    """
    return F.length(c) - F.length(F.translate(c, spelled(letters), ""))


def alphabet(c: Column | str) -> Column:
    """struct(alphabet, cyr_ratio, lat_ratio) by the shares of two scripts; empty and other texts have shares of 0."""
    low = F.lower(F.coalesce(col(c), F.lit("")))
    cyr, lat = count_of(low, CYRILLIC), count_of(low, "a-z")
    a = F.coalesce(F.try_divide(cyr.cast("double"), (cyr + lat).cast("double")), F.lit(0.0))
    b = F.coalesce(F.try_divide(lat.cast("double"), (cyr + lat).cast("double")), F.lit(0.0))
    name = (
        F.when(low == "", "empty")
        .when(cyr + lat == 0, "other")
        .when(a > 0.8, "cyrillic")
        .when(b > 0.8, "latin")
        .when((a > 0.4) & (b > 0.4), "mixed")
        .when(a > 0.3, "cyrillic")
        .when(b > 0.3, "latin")
        .otherwise("other")
    )
    return F.struct(name.alias("alphabet"), a.alias("cyr_ratio"), b.alias("lat_ratio"))


def script(c: Column | str, default: str = "unknown") -> Column:
    """arabic, cyrillic or latin, whichever prevails; of equals latin, then cyrillic.

    The greatest of counts with names has each count once; the branches of a CASE would count anew.
    """
    t = F.coalesce(col(c), F.lit(""))
    low = F.lower(t)
    counts = [(F.lit(0), default), (count_of(low, "a-z"), "latin"), (count_of(low, CYRILLIC_PLAIN), "cyrillic"), (count_of(t, "؀-ۿ"), "arabic")]
    return F.greatest(*[F.struct(n.alias("n"), F.lit(-i).alias("rank"), F.lit(name).alias("name")) for i, (n, name) in enumerate(counts)])["name"]


def letters_fit(c: Column | str, required: str, forbidden: str = "") -> Column:
    """At least one required letter and no forbidden one; case counts."""
    out = F.lit(True)
    if forbidden:
        out = out & ~col(c).rlike(f"[{forbidden}]")
    return out & col(c).rlike(f"[{required}]") if required else out


def fits_language(c: Column | str, language: Column | str, rules: dict[str, tuple[str, str]] | None = None) -> Column:
    """letters_fit() by each row's language; a language without rules takes all."""
    out = None
    for k, (required, forbidden) in (rules or LETTER_RULES).items():
        fit, mine = letters_fit(c, required, forbidden), col(language) == k
        out = F.when(mine, fit) if out is None else out.when(mine, fit)
    return out.otherwise(F.lit(True))


def to_cyrillic(c: Column | str) -> Column:
    """Tatar Latin to Cyrillic: digraphs in their order, then single letters."""
    out = reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), DIGRAPHS.items(), col(c))
    return F.translate(out, LATIN, TATAR)
