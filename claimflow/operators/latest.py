"""Latest row per group (top-1) and its lookup join.

The latest row of a group has the greatest date; ties go to the smallest name, a
missing one last, then to the smallest payload; rows without any date never win, and
a group with no date at all yields no row.

The winning day is found first, by a hash aggregate over (group, day), two columns of
fixed width that combine map-side.  Names and payloads, texts of any length, are
fetched by a join for the rows of that day alone, and the first of them is picked by
``row_number() = 1``, which Spark limits to one row per group and task before the
shuffle: no task sorts or holds a hot group, and no text meets the aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_day(df: DataFrame, group: str, day: str) -> DataFrame:
    """``group`` (missing ones are a group) and its greatest ``day``."""
    return df.filter(F.col(day).isNotNull()).groupBy(group).agg(F.max(day).alias(day))


def first_of_tied(tied: DataFrame, group: str, tiebreak: str, payload: Sequence[str]) -> DataFrame:
    """One row per group of rows that share the group's latest day."""
    order = [F.col(tiebreak).asc_nulls_last(), *[F.col(c) for c in payload]]
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return tied.withColumn("_place", place).filter(F.col("_place") == 1).select(group, *payload)


def latest_per_group(df: DataFrame, group: str, order_date: Column, tiebreak: Column,
                     payload: Sequence[str]) -> DataFrame:
    """One row per ``group``: the payload of its latest row."""
    dated = df.select(group, order_date.alias("_day"), tiebreak.alias("_tie"), *payload)
    last = latest_day(dated, group, "_day").toDF("_group", "_last")
    tied = dated.join(last, dated[group].eqNullSafe(last["_group"]) & (dated["_day"] == last["_last"]))
    return first_of_tied(tied, group, "_tie", payload)


def attach_lookup(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join to a lookup that is unique on ``right_key``; missing keys match
    each other, and only the left key survives."""
    return (df.join(lookup, df[left_key].eqNullSafe(lookup[right_key]), "left")
            .drop(lookup[right_key]))
