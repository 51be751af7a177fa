"""Joins and ranges that keep a hot key from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_KEYS of the rows; so at most
# HOT_KEYS keys are hot, which bounds the only broadcast made here.
HOT_KEYS = 256


def lookup(rows: DataFrame, groups: DataFrame, keys: list[str], weight: str,
           how: str = "inner") -> DataFrame:
    """``rows`` joined with ``groups`` (one row per key) on ``keys``.

    ``groups[weight]`` is the number of rows that have the key.  The few keys
    that hold more than 1/256 of all rows are looked up through a broadcast of
    at most 256 rows, so their rows stay where they are; all other keys go
    through an ordinary equi-join whose groups are bounded.  Both inputs are
    read twice and should be staged tables.  ``weight`` is dropped.  A null key
    matches nothing; with ``how="left"`` its row stays.
    """
    size = groups.agg(F.sum(weight).alias("all"), F.max(weight).alias("most")).first()
    limit = max((size["all"] or 0) // HOT_KEYS, 1000)
    hot = F.broadcast(groups.filter(F.col(weight) > limit).drop(weight))
    values = [c for c in groups.columns if c not in keys and c != weight]
    if not values:
        raise ValueError("groups carry no column besides the key")
    if (size["most"] or 0) <= limit:  # no key is hot
        return rows.join(groups.drop(weight), keys, how).select(*rows.columns, *values)
    direct = rows.join(hot, keys, "inner").select(*rows.columns, *values)
    cold = rows.join(hot.select(*keys), keys, "left_anti")
    rest = cold.join(groups.filter(F.col(weight) <= limit).drop(weight), keys, how)
    return direct.unionByName(rest.select(*rows.columns, *values))


def unit_interval(*parts: Column) -> Column:
    """A reproducible uniform number in [0, 1) from the hash of ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0 ** -53)
