"""Payment rollup per benefit claimed.

Measures, with a missing value poisoning its group (a summary that does not
drop missing values: one missing amount makes the total missing):

* ``total_paid``            sum of amounts: exact, and so independent of row
                            order, when every amount of the group is a decimal
                            of at most 20 digits before and 8 after the point;
                            a sum of doubles otherwise (NaN stays NaN)
* ``first_payment``         min of coalesce(start, release)
* ``last_payment``          max of coalesce(through, release)
* ``last_amount``           amount of the row with the latest release date; ties
                            go to the smallest line number, then to the smallest
                            amount, missing ones last (see :func:`pick_order`)
* ``eff_date_last_payment`` max of release

Every step is two hash aggregates: first the rows of one (key, day and line) are
reduced to their sums and their least amount, then those of a key, where the least
(day and line) brings its amount along.  The tie order is so exact for any amount,
and every buffer is a number or date of fixed width: no task sorts payments, both
steps combine map-side, and a hot benefit is spread over its days and lines (or what
its rows were dealt by, see :func:`states`) before it is brought together.  The states merge by the same two steps, so a plan can
reduce payments by their foreign key before it joins the (much smaller) result to
the parent and finishes by name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("total_paid", "first_payment", "last_payment", "last_amount",
            "eff_date_last_payment")
EXACT = "decimal(28,8)"
LAST_DAY = 5_000_000    # counted from 1970; every date that Spark knows is before it

_SUMS = ("n", "n_amount", "n_exact", "exact", "total", "n_first", "n_last", "n_release")


def pick_at(release: Column, tiebreak: Column) -> Column:
    """Day and line as one whole number, smallest first; null without a release date.

    The latest day comes first, then the smallest line number (32 bits), a missing one last.
    """
    day = (F.lit(LAST_DAY) - F.unix_date(release)).cast("bigint")
    return day * 2 ** 34 + F.coalesce(tiebreak.cast("bigint") + 2 ** 31, F.lit(2 ** 33))


def _combined() -> list[Column]:
    """Aggregates that bring states together, but for the pick."""
    return [*[F.sum(c).alias(c) for c in _SUMS], F.min("first").alias("first"), F.max("last").alias("last"),
            F.max("eff").alias("eff")]


def _picked(reduced: DataFrame, keys: list[str]) -> DataFrame:
    """States of one (key, pick_at) each -> one state per key."""
    return reduced.groupBy(*keys).agg(*_combined(), F.min_by("pick", "pick_at").alias("pick"),
                                      F.min("pick_at").alias("pick_at"))


def states(payments: DataFrame, keys: list[str], amount: Column, start: Column, through: Column,
           release: Column, tiebreak: Column, dealt: Sequence[str] = ()) -> DataFrame:
    """One partial state per ``keys`` (missing keys are a group) of contribution rows.

    ``dealt``: columns that follow from the release date and by which, with ``keys``, the
    rows were dealt over the tasks.  The first step then needs no exchange, and the second
    one carries a state per key and task.
    """
    exact = amount.try_cast(EXACT)
    rows = payments.select(
        *keys, *dealt, amount.alias("amount"), F.when(exact.cast("double") == amount, exact).alias("fits"),
        F.coalesce(start, release).alias("first"), F.coalesce(through, release).alias("last"),
        release.alias("release"), pick_at(release, tiebreak).alias("pick_at"))
    reduced = rows.groupBy(*keys, *dealt, "pick_at").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("amount").alias("n_amount"),
        F.count("fits").alias("n_exact"),
        F.sum("fits").alias("exact"),
        F.sum("amount").alias("total"),
        F.count("first").alias("n_first"),
        F.min("first").alias("first"),
        F.count("last").alias("n_last"),
        F.max("last").alias("last"),
        F.count("release").alias("n_release"),
        F.max("release").alias("eff"),
        F.min("amount").alias("pick"),   # numbers before NaN, missing ones last
    )
    return _picked(reduced, keys)


def merged(partial: DataFrame, keys: list[str]) -> DataFrame:
    """One state per ``keys`` from states of finer groups."""
    return _picked(partial.groupBy(*keys, "pick_at").agg(*_combined(), F.min("pick").alias("pick")), keys)


def measure_columns() -> list[Column]:
    """Measures from the state columns, nulling a measure whose inputs had a
    missing value.  A row without states (no payments) gets all nulls."""
    complete = lambda n: F.col(n) == F.col("n")
    return [
        F.when(complete("n_amount"),
               F.when(F.col("n_exact") == F.col("n_amount"), F.col("exact").cast("double"))
               .otherwise(F.col("total"))).alias("total_paid"),
        F.when(complete("n_first"), F.col("first")).alias("first_payment"),
        F.when(complete("n_last"), F.col("last")).alias("last_payment"),
        F.when(complete("n_release"), F.col("pick")).alias("last_amount"),
        F.when(complete("n_release"), F.col("eff")).alias("eff_date_last_payment"),
    ]


def finish(partial: DataFrame, key: str) -> DataFrame:
    """States -> one row of measures per ``key``."""
    return partial.select(key, *measure_columns())


def rollup_payments(payments: DataFrame, key: str = "benefit_claimed_name",
                    amount: str = "amount", start: str = "start", through: str = "through",
                    release: str = "release", tiebreak: str = "line_number") -> DataFrame:
    """One row per ``key`` of a payments extract (contribution grain)."""
    return finish(states(payments, [key], F.col(amount), F.col(start), F.col(through), F.col(release),
                         F.col(tiebreak)), key)
