"""Dates from text, with a confidence.  ``as_of`` stands for now; nothing reads the clock."""

from __future__ import annotations

import calendar
import functools
import re
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The formats, in the order they are tried.
FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd",
    "M/d/yyyy", "M-d-yyyy", "d/M/yyyy", "d-M-yyyy", "yyyy-M-d H:m:s", "M/d/yyyy H:m:s", "MMMM d, yyyy", "MMM d, yyyy", "MMMM d yyyy",
    "MMM d yyyy", "MMMM d, yyyy H:m:s", "MMM d, yyyy H:m:s",
]
# Confidence of each step.
ISO, COMMON, RELATIVE, FUZZY = 0.99, 0.95, 0.85, 0.70
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800, "month": 30 * 86400, "year": 365 * 86400}
#: How an amount of time is said before "ago", and its seconds: a unit's name, alone or as a plural, after a gap; or
#: its first letter right behind the number; ``m`` is a month.
_AGO = {f" {name}{end}": n for name, n in _SECONDS.items() for end in ("", "s")} | {name[0]: n for name, n in _SECONDS.items() if name not in ("second", "minute")}
_ISO = r"^\d{4}(-\d{2}(-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?)?)?$"
_SHAPES = {"yyyy": r"\d{4}", "MMMM": "[A-Za-z]+", "MMM": "[A-Za-z]+", "SSSSSS": r"\d{6}", "XXX": r"(?:Z|[+-]\d{2}:\d{2})", "'T'": "T"}


def _shape(pattern: str) -> str:
    """A regular expression for texts a format may read: failed parses cost far more than a look."""

    def one(m: re.Match) -> str:
        token = m[0]
        return _SHAPES.get(token) or (r"\d{2}" if len(token) == 2 else r"\d{1,2}")

    return re.sub(r"'T'|y+|M+|d+|H+|m+|s+|S+|X+", one, pattern)


def _in_prose() -> list[str]:
    """Patterns of dates inside a text, made from the formats: ISO dates with or without their time, dates with the name
    of a month (cut short or not), and dates of numbers with strokes, year last or first."""
    time = rf"{_shape('HH:mm:ss')}(?:\.\d+)?(?:{_shape('XXX')})?"
    iso = rf"{_shape('yyyy-MM-dd')}(?:T{time})?"
    names = "|".join(calendar.month_abbr[1:])
    named = [_shape(f).replace("[A-Za-z]+", rf"(?:{names})[a-z]*") for f in FORMATS if f.startswith("MMMM") and "H" not in f]
    strokes = [_shape(f) for f in ("M/d/yyyy", "yyyy/M/d")]
    return [r"\b(?:" + "|".join(each) + r")\b" for each in ([iso], named, strokes)]


IN_TEXT = _in_prose()


def iso(s: Column) -> Column:
    """ISO 8601: years, months, dates, times with or without offset, basic dates, weeks and ordinals."""
    plain = F.when(s.rlike(_ISO), F.try_to_timestamp(F.regexp_replace(s, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2})(Z|[+-]\d{2}:?\d{2})?$", "$1:00$2")))
    basic = F.when(s.rlike(r"^\d{8}$"), F.try_to_timestamp(s, F.lit("yyyyMMdd")))
    year = F.regexp_extract(s, r"^(\d{4})", 1).try_cast("int")
    start = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(start, F.weekday(start))
    week = F.regexp_extract(s, r"^\d{4}-W(\d{2})", 1).try_cast("int")
    day = F.coalesce(F.nullif(F.regexp_extract(s, r"^\d{4}-W\d{2}-(\d)$", 1), F.lit("")).try_cast("int"), F.lit(1))
    by_week = F.when(s.rlike(r"^\d{4}-W(0[1-9]|[1-4]\d|5[0-3])(-[1-7])?$"), F.date_add(monday, (week - 1) * 7 + day - 1).cast("timestamp"))
    number = F.regexp_extract(s, r"^\d{4}-(\d{3})$", 1).try_cast("int")
    by_day = F.when(s.rlike(r"^\d{4}-(0\d[1-9]|0[1-9]\d|[12]\d\d|3[0-5]\d|36[0-6])$"), F.date_add(F.make_date(year, F.lit(1), F.lit(1)), number - 1).cast("timestamp"))
    return F.coalesce(plain, basic, by_week, by_day)


def common(s: Column) -> Column:
    return F.coalesce(*[F.when(s.rlike(f"^{_shape(f)}$"), F.try_to_timestamp(s, F.lit(f))) for f in FORMATS])


def relative(s: Column, as_of: Column) -> Column:
    """``3 days ago``, ``2h ago``, ``yesterday``; months have 30 days and years 365."""
    s = F.trim(F.lower(s))
    parts = r"^(\d+)(\s*)([a-z]+)\s+ago$"
    gap = F.when(F.regexp_extract(s, parts, 2) != "", " ").otherwise("")
    said = F.create_map(*[F.lit(x) for kv in _AGO.items() for x in kv])
    each = F.try_element_at(said, F.concat(gap, F.regexp_extract(s, parts, 3)))
    named = F.when(s == "yesterday", 86400).when(s == "today", 0).when(s == "tomorrow", -86400)
    # What does not end in "ago" is told by a look at its end.
    seconds = F.coalesce(named.cast("long"), F.when(F.endswith(s, F.lit("ago")), F.regexp_extract(s, parts, 1).try_cast("long") * each))
    return F.timestamp_micros(F.unix_micros(as_of) - seconds * F.lit(1_000_000))


@functools.lru_cache(1 << 14)
def _parsed(x: str, day: datetime) -> datetime | None:
    """What the lenient parser reads; pages of one site say the same days again and again."""
    from dateutil import parser

    try:
        t = pd.Timestamp(parser.parse(x, fuzzy=True, default=day))
        return (t.tz_convert("UTC").tz_localize(None) if t.tzinfo else t).to_pydatetime()
    except Exception:  # whatever the parser makes of a page's text, it is no date
        return None


@F.pandas_udf(T.ArrayType(T.TimestampType()))
def _lenient(texts: pd.Series, base: pd.Series) -> pd.Series:
    days = [pd.Timestamp(b).to_pydatetime().replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None) for b in base]
    return pd.Series([None if xs is None else [None if x is None else _parsed(x, day) for x in xs] for xs, day in zip(texts, days, strict=True)], dtype=object)


def with_read(rows: DataFrame, texts: Column, as_of: Column, name: str) -> DataFrame:
    """Adds ``name``: the whole cascade for each text of an array, as structs of ``ts`` and ``confidence``; the lenient parser takes
    missing parts from the day of ``as_of`` and sees only what the other steps leave null.

    What the first steps read becomes a column of its own, which is used by its name, so the plan holds the cascade once."""
    rows = rows.withColumn("__texts", texts).withColumn("__early", F.transform("__texts", lambda x: cascade(x, as_of)))
    rest = F.zip_with("__texts", "__early", lambda x, e: F.when(e["ts"].isNull() & (F.trim(x) != ""), F.trim(x)))
    rows = rows.withColumn("__rest", rest)
    rows = rows.withColumn("__late", _lenient(F.when(F.exists("__rest", lambda x: x.isNotNull()), F.col("__rest")), as_of))
    read = F.zip_with("__early", "__late", lambda e, t: F.when(t.isNull(), e).otherwise(_found(t, FUZZY)))
    return rows.withColumn(name, F.when(F.col("__late").isNull(), F.col("__early")).otherwise(read)).drop("__texts", "__early", "__rest", "__late")


def _found(ts: Column, confidence: float) -> Column:
    return F.struct(ts.alias("ts"), F.lit(confidence).alias("confidence"))


def cascade(s: Column, as_of: Column) -> Column:
    """Struct of ``ts`` and ``confidence`` of the steps that need no Python: ISO, then the formats, then relative; null
    and 0.0 if nothing fits."""
    s = F.trim(s)
    steps = [(iso(s), ISO), (common(s), COMMON), (relative(s, as_of), RELATIVE)]
    return F.coalesce(*[F.when(c.isNotNull(), _found(c, p)) for c, p in steps], _found(F.lit(None).cast("timestamp"), 0.0))


def in_text(x: Column) -> Column:
    """Dates written in prose: ISO ones, then with month names, then numeric."""
    return F.concat(*[F.regexp_extract_all(x, F.lit(p), F.lit(0)) for p in IN_TEXT])


def is_fresh(ts: Column, as_of: Column, hours: int = 24) -> Column:
    """At most so many hours old; the future is fresh."""
    return F.unix_micros(as_of) - F.unix_micros(ts) <= F.lit(hours * 3_600_000_000)
