"""Tolerant casts (text extracts arrive untyped) and period helpers.

The source extracts deliver every field as text; numbers and dates are cast
late and a value that does not parse becomes null instead of failing the job
(Spark's ANSI mode would raise on a plain ``cast``).  The helpers are
type-aware at the DataFrame level: a column that is already typed is left
alone, so the same report code runs on raw text extracts and on typed
parquet extracts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed text shapes accepted as dates: year-month-day with '-' or '/' between
# the parts (anything after the day, e.g. a time of day, is ignored), or eight
# digits yyyymmdd with nothing else.
_YMD_PREFIX = r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}"
_YMD_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"


# Fixed text shape accepted as a number: decimal digits with an optional sign,
# point and exponent, blanks around them.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


# A field of nothing but blanks is a missing one.
BLANK = r"^\s*$"


def parse_number(text: Column) -> Column:
    """Text to double; any other text, number suffixes and NaN included, gives null."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def parse_date(text: Column) -> Column:
    """Text to date; unparsable text gives null.

    Accepts ``2022-01-31``, ``2022/01/31``, ``20220131`` and timestamps such as
    ``2022-01-31T23:30:00.000Z`` (the calendar day is kept, no time-zone shift).
    """
    dashed = F.regexp_replace(F.regexp_extract(text, _YMD_PREFIX, 0), "/", "-")
    compact = F.regexp_replace(F.regexp_extract(text, _YMD_COMPACT, 0), _YMD_COMPACT, "$1-$2-$3")
    return F.coalesce(dashed.try_cast("date"), compact.try_cast("date"))


def as_number(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``mutate_at(cols, as.numeric)``: one pass over a named set of columns."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out = {}
    for c in cols:
        if isinstance(types[c], T.StringType):
            out[c] = parse_number(F.col(c))
        elif not isinstance(types[c], T.DoubleType):
            out[c] = F.col(c).cast("double")
    return df.withColumns(out) if out else df


def as_date(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``mutate_at(cols, ymd)`` / ``as.Date``: tolerant date cast of named columns."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out = {}
    for c in cols:
        if isinstance(types[c], T.StringType):
            out[c] = parse_date(F.col(c))
        elif not isinstance(types[c], T.DateType):
            out[c] = F.col(c).cast("date")
    return df.withColumns(out) if out else df


def date_column(df: DataFrame, name: str) -> Column:
    """The column as a date, whether it was delivered typed or as text."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return parse_date(F.col(name))
    return F.col(name) if isinstance(kind, T.DateType) else F.col(name).cast("date")


def lost(df: DataFrame, name: str, kind: str) -> Column:
    """The raw text of ``name`` where it is neither missing nor blank and does not parse as a
    ``kind`` (number or date); null elsewhere, and always for a column that is delivered typed."""
    raw = F.col(f"`{name}`")
    if not isinstance(df.schema[name].dataType, T.StringType):
        return F.lit(None).cast("string")
    parsed = {"number": parse_number, "date": parse_date}[kind](raw)
    return F.when(~raw.rlike(BLANK) & parsed.isNull(), raw)


def prior_month_end(d: Column) -> Column:
    """Last day of the month before ``d`` (also when ``d`` is itself a month end)."""
    return F.date_sub(F.trunc(d, "month"), 1)


def as_text(c: Column) -> Column:
    """Render a typed value the way the extract delivers it (dates as yyyy-MM-dd)."""
    return c.cast("string")
