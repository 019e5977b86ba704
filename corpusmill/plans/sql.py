"""SQL fragments shared by the oracles; each mirrors a Column builder."""

from __future__ import annotations

from ..functions import text as X
from ..functions.scripts import DIGRAPHS, LATIN, TATAR


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def squeeze(c: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({c}, ''), {lit(X.WS + '+')}, ' ', 'g'), '^ | $', '', 'g')"


def strip(c: str) -> str:
    return f"regexp_replace({c}, {lit(f'^{X.WS}+|{X.WS}+$')}, '', 'g')"


def normal_form(c: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(lower({c}), {lit(X.WS + '+')}, ' ', 'g'), {lit(X.NOT_W_OR_WS)}, '', 'g'), '^ +| +$', '', 'g')"


def tokens(c: str) -> str:
    return f"regexp_extract_all(lower({c}), {lit(X.W + '+')})"


def words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, {lit(X.WS + '+')}), lambda t: t <> '')"


def excerpt(c: str, n: int = 260) -> str:
    return f"CASE WHEN length({c}) > {n} THEN substr({c}, 1, {n}) || '...' ELSE {c} END"


def without_boilerplate(c: str) -> str:
    out = f"coalesce({c}, '')"
    for p in X.BOILERPLATE:
        out = f"regexp_replace({out}, {lit('(?m)' + p)}, '', 'g')"
    return squeeze(f"regexp_replace({out}, '<[^>]+>', ' ', 'g')")


def without_emoji(c: str) -> str:
    return strip(f"regexp_replace({c}, {lit(X.EMOJI)}, '', 'g')")


def to_cyrillic(c: str) -> str:
    for a, b in DIGRAPHS.items():
        c = f"replace({c}, {lit(a)}, {lit(b)})"
    return f"translate({c}, {lit(LATIN)}, {lit(TATAR)})"


def domain(c: str) -> str:
    return f"lower(regexp_extract({c}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"


def path(c: str) -> str:
    return f"regexp_extract({c}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
