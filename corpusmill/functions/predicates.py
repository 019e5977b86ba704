"""Column builders that accept or reject: URLs, texts, authors, categories, lengths, measurements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import urls
from .text import WS, col, name_tokens, squeeze, words

# Parts of noise URLs, labels, months and patterns that mark what is no author or category.
NOISE_PARTS = ("/photo/", "/video/", "/special-projects/", "/widget/", "/tag/list/", "vkvideo", "youtube", "youtu.be", "instagram", "facebook", "telegram", "ok.ru", "/login", "/signup", "/signin", "/register")
MONTHS = (
    "январ", "феврал", "март", "апрел", "мая", "май", "июн", "июл", "август", "сентябр", "октябр", "ноябр",
    "декабр", "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november",
    "december", "jan", "feb", "mar", "apr", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
)
CONTENT_LABEL = (
    r"(?iu)^\s*(?:партн[её]рск(?:ий|ая|ое|ие)\s+материал|маводи\s+шарикона|спонсорск(?:ий|ая|ое|ие)\s+материал|рекламн(?:ый|ая|ое|ые)\s+материал|реклама|промо"
    r"|advertorial|sponsored(?:\s+content|\s+post)?|partner\s+material|paid\s+post|reading\s+time|time\s+to\s+read|время\s+чтения)\s*$"
)
PHOTO_CREDIT = r"(?iu)^\s*(?:АКС|ФОТО|ФОТОГРАФИЯ|Photo|Credit)\s*[:：\-—]"
LOGIN = r"(?i)^\s*(?:admin|administrator|webmaster|root|guest|anonymous|noreply|no-reply)\s*$"
READING_TIME = (
    r"(?iu)^\s*\d+\s*(мин|мин\.|минут[аыу]?|час(а|ов)?|ч|сек(унд[аыу]?)?|min(ute)?s?|hour(s)?|hrs?|sec(ond)?s?)(\s+(чтения|просмотра|на\s+чтение|чтение|(?:to\s+)?read(?:ing)?))?\s*\.?\s*$"
)
DATE_ONLY = r"(?i)^\s*(\d{1,4}[-./]\d{1,2}([-./]\d{1,4})?)(?:[T\s]\d{1,2}:\d{2}(?::\d{2})?(?:[+-]\d{2}:?\d{2}|Z)?)?\s*$"
LETTERS = "[A-Za-zА-Яа-яЁёӨөҮүҚқҒғҲҳҶҷӢӣ]{2,}"
GENERIC = (
    "главная", "главная страница", "home", "main", "index", "начало", "новости", "новость", "news", "novosti", "common_material", "common materials", "материалы", "статьи",
    "фото", "photo", "видео", "video", "архив", "archive", "разное", "other", "прочее", "рубрика", "категория", "раздел", "тег", "tag", "rubric", "category",
)
DATE_IN_CATEGORY = (
    r"(?iu)\d{1,2}\s+(?:январ|феврал|март|апрел|ма[йя]|июн|июл|август|сентябр|октябр|ноябр|декабр"
    r"|january|february|march|april|may|june|july|august|september|october|november|december)"
)


def contains_any(c: Column, parts: tuple[str, ...] | list[str]) -> Column:
    """One pattern search, whatever the number of parts."""
    escaped = ["".join("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch for ch in p) for p in parts]
    return c.rlike("|".join(escaped)) if escaped else F.lit(False)


def is_noise_url(url: Column | str, parts: tuple[str, ...] = NOISE_PARTS) -> Column:
    u = F.coalesce(col(url), F.lit(""))
    return (u == "") | contains_any(F.lower(u), parts)


def is_noise_text(text: Column | str, noise: tuple[str, ...] | list[str] = ()) -> Column:
    """Under three characters, or with a noise word anywhere."""
    t = F.lower(squeeze(text))
    return (F.length(t) < 3) | contains_any(t, noise)


def is_author(name: Column | str) -> Column:
    """Whether a value can name a person or an editorial office."""
    t = F.trim(F.coalesce(col(name), F.lit("")))
    low = F.lower(t)
    return (
        F.length(t).between(2, 120)
        & ~t.rlike(CONTENT_LABEL)
        & ~t.rlike(PHOTO_CREDIT)
        & ~t.rlike(LOGIN)
        & ~t.rlike(READING_TIME)
        & ~t.rlike(DATE_ONLY)
        & ~(low.rlike("[0-9]") & contains_any(low, MONTHS))
        & ~low.isin("сегодня", "вчера", "позавчера")
        & ~t.rlike("^(https?://|www\\.)|@")
        & t.rlike(LETTERS)
    )


def category(value: Column | str, measuring: bool = False) -> Column:
    """The category, squeezed, or null. The two rules differ on slugs: two hyphens and no space, or (measuring) one and all lower case."""
    s = squeeze(value)
    low = F.lower(s)
    slug = ~s.contains(" ") & ((s.contains("-") & (s == low)) if measuring else s.rlike("-.*-"))
    bad = (s == "") | s.rlike(r"^[\[{]") | s.rlike("@context|@type") | (F.length(s) > 120) | low.isin(*GENERIC) | s.rlike(DATE_IN_CATEGORY) | slug | s.rlike("^[a-z]{3,}$")
    return F.when(~bad, s)


def is_category(value: Column | str) -> Column:
    """The plainer rule of coverage counts."""
    t = F.trim(F.coalesce(col(value), F.lit("")))
    return (t != "") & ~t.startswith("{") & (F.length(t) <= 100)


def is_article_url(url: Column | str, pattern: str | None = None, filters: tuple[str, ...] = ()) -> Column:
    """A site's pattern decides alone; else its substrings; else the usual ones."""
    low = F.lower(F.coalesce(col(url), F.lit("")))
    if pattern:
        return low.rlike(pattern) | F.lower(urls.path(url)).rlike(pattern)
    return contains_any(low, tuple(f.lower() for f in filters) or urls.ARTICLE_PARTS)


def is_excluded_url(url: Column | str, excludes: tuple[str, ...]) -> Column:
    return contains_any(F.lower(col(url)), tuple(e.lower() for e in excludes))


def is_garbage(text: Column | str) -> Column:
    """80 characters or more that are mostly no letters, digits or spaces, or 200 words or more that are mostly repeats."""
    t = F.coalesce(col(text), F.lit(""))
    n = F.length(t)
    kept = F.length(F.regexp_replace(t, WS.replace("[", r"[^\p{L}\p{N}", 1), ""))
    w = words(F.lower(t))
    return (n >= 80) & ((kept / n < 0.5) | ((F.size(w) >= 200) & (F.size(F.array_distinct(w)) / F.size(w) < 0.05)))


def has_class(classes: Column | str, excluded: list[str]) -> Column:
    return F.arrays_overlap(col(classes), F.array(*[F.lit(x) for x in excluded]))


def is_hidden_path(p: Column | str) -> Column:
    return col(p).rlike(r"(^|/)\.")


def authors_match(a: Column | str, b: Column | str) -> Column:
    """Two shared name tokens, or one token each and the same; null if either has none."""
    x, y = F.array_distinct(name_tokens(a)), F.array_distinct(name_tokens(b))
    shared = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), (shared >= 2) | ((F.size(x) == 1) & (F.size(y) == 1) & (shared == 1)))


def dates_match(a: Column | str, b: Column | str) -> Column:
    return F.substring(col(a), 1, 10) == F.substring(col(b), 1, 10)


def titles_match(title: Column | str, reference: Column | str) -> Column:
    """The reference's first 30 characters stand in the title."""
    return F.lower(squeeze(title)).contains(F.lower(F.substring(squeeze(reference), 1, 30)))
