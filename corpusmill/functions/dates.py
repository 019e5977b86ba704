"""Column builders for dates in words and figures."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, squeeze

# Russian month names in the order in which they are replaced, and the English ones.
RUSSIAN_MONTHS = {
    "января": "January", "Января": "January", "январь": "January", "Январь": "January",
    "февраля": "February", "Февраля": "February", "февраль": "February", "Февраль": "February",
    "марта": "March", "Марта": "March", "март": "March", "Март": "March",
    "апреля": "April", "Апреля": "April", "апрель": "April", "Апрель": "April",
    "мая": "May", "Мая": "May", "май": "May", "Май": "May",
    "июня": "June", "Июня": "June", "июнь": "June", "Июнь": "June",
    "июля": "July", "Июля": "July", "июль": "July", "Июль": "July",
    "августа": "August", "Августа": "August", "август": "August", "Август": "August",
    "сентября": "September", "Сентября": "September", "сентябрь": "September", "Сентябрь": "September",
    "октября": "October", "Октября": "October", "октябрь": "October", "Октябрь": "October",
    "ноября": "November", "Ноября": "November", "ноябрь": "November", "Ноябрь": "November",
    "декабря": "December", "Декабря": "December", "декабрь": "December", "Декабрь": "December",
}

ISO = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(?::(\d{2}))?)?(Z|[+-]\d{2}:\d{2})?$"


def localised(c: Column | str, months: dict[str, str] = RUSSIAN_MONTHS) -> Column:
    """Month names replaced by English ones, one after the other."""
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), months.items(), col(c))


def iso(c: Column | str) -> Column:
    """An ISO date or time with its seconds and offset written out; null for anything else."""
    t = squeeze(c)
    part = lambda k: F.regexp_extract(t, ISO, k)
    time = F.when(part(2) == "", F.lit("00:00:00")).otherwise(F.concat(part(2), F.lit(":"), F.coalesce(F.nullif(part(3), F.lit("")), F.lit("00"))))
    zone = F.when(part(4) == "Z", F.lit("+00:00")).otherwise(part(4))
    return F.when(part(1) != "", F.concat(part(1), F.lit("T"), time, zone))


def parsed(c: Column | str, months: dict[str, str] = RUSSIAN_MONTHS, default: str = "2024-01-01", day_first: bool = True) -> Column:
    """An ISO time, else what a lenient parser makes of the localised text (missing parts from default), else the text."""
    from dateutil import parser

    @F.pandas_udf("string")
    def lenient(s: pd.Series) -> pd.Series:
        def one(t):
            if not t:
                return None
            try:
                return parser.parse(t, fuzzy=True, ignoretz=True, dayfirst=day_first, default=datetime.fromisoformat(default)).isoformat()
            except (ValueError, OverflowError, TypeError):
                return t

        return s.map(one)

    t = squeeze(c)
    return F.when(t == "", F.lit(None)).otherwise(F.coalesce(iso(c), lenient(F.when(iso(c).isNull(), localised(t, months)))))


def clock(c: Column | str) -> Column:
    """The first H:MM or HH:MM."""
    return F.nullif(F.regexp_extract(col(c), r"\b(\d{1,2}:\d{2})\b", 1), F.lit(""))


def epoch_iso(seconds: Column | str) -> Column:
    """Local ISO time of an epoch, in the session's time zone."""
    return F.date_format(F.timestamp_seconds(col(seconds)), "yyyy-MM-dd'T'HH:mm:ss")


def epoch_clock(seconds: Column | str) -> Column:
    return F.date_format(F.timestamp_seconds(col(seconds)), "HH:mm")
