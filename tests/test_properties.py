"""Property tests: the tolerant date parser against a plain statement of its rule."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimflow.functions.casts import parse_date

_DASHED = re.compile(r"^([0-9]{4})[-/]([0-9]{1,2})[-/]([0-9]{1,2})")
_COMPACT = re.compile(r"^([0-9]{4})([0-9]{2})([0-9]{2})$")


def reference(s):
    """Year-month-day with '-' or '/' (anything after the day ignored), or
    exactly eight digits; an impossible calendar date is missing."""
    if s is None:
        return None
    m = _DASHED.match(s) or _COMPACT.match(s)
    if not m:
        return None
    try:
        return dt.date(int(m.group(1)), int(m.group(2)), int(m.group(3)))
    except ValueError:
        return None


def _date_text(y, m, d, style, tail):
    sep = {"dash": "-", "slash": "/", "mixed": "-"}[style] if style != "compact" else ""
    if style == "compact":
        return f"{y:04d}{m:02d}{d:02d}"
    second = "/" if style == "mixed" else sep
    return f"{y:04d}{sep}{m}{second}{d:02d}{tail}"


texts = st.one_of(
    st.builds(_date_text, st.integers(1000, 2999), st.integers(0, 13), st.integers(0, 32),
              st.sampled_from(["dash", "slash", "mixed", "compact"]),
              st.sampled_from(["", "T23:30:00.000Z", " 10:00", "x"])),
    st.text(alphabet="0123456789-/T: abc", max_size=14),
    st.none(),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(texts, min_size=50, max_size=150))
def test_parse_date_matches_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.d for r in df.select("i", parse_date(F.col("s")).alias("d")).collect()}
    for i, v in enumerate(values):
        assert got[i] == reference(v), (v, got[i])
