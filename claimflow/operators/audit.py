"""Row-count audit of pipeline stages, as a DataFrame.

The metrics of a stage come of one pass over it; the audit is the union of the
stages' metrics, and nothing but that handful of rows reaches the driver.  Rows in
and fan-out need no second read of a stage's input: its rows are numbered, and the
output of left joins still names each of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


ROW = "_row"   # names an input row of a stage in the rows that come of it


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with a number for each row; stage the result before it is counted, so that
    the numbers are given once."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def _long(metrics: DataFrame, stage: str) -> DataFrame:
    """One row of named numbers -> rows (stage, metric, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias("value"))
                      for c in metrics.columns])
    return metrics.select(F.lit(stage).alias("stage"), F.explode(pairs).alias("m")).select("stage", "m.metric", "m.value")


def counted(stage: str, df: DataFrame, **counts: Column) -> DataFrame:
    """The rows of ``df`` and how many of them meet each condition, in one pass."""
    return _long(df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()]), stage)


def matched(stage: str, df: DataFrame, keep: Column | None = None, **counts: Column) -> DataFrame:
    """A stage of left joins, in one pass over its output, which carries the number of its input row.

    ``rows_in``: input rows; ``fan_out``: the most output rows that came of one of them;
    ``rows``: output rows (those that ``keep`` holds for); and of the output rows how many
    meet each condition.
    """
    per_row = df.groupBy(ROW).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.lit(True) if keep is None else keep).alias("_kept"),
                                  *[F.count_if(c).alias(n) for n, c in counts.items()])
    return _long(per_row.agg(F.count(F.lit(1)).alias("rows_in"), F.max("_n").alias("fan_out"), F.sum("_kept").alias("rows"),
                             *[F.sum(n).alias(n) for n in counts]), stage)


def audit(metrics: Iterable[DataFrame]) -> DataFrame:
    out = None
    for m in metrics:
        out = m if out is None else out.unionByName(m)
    return out


def observed_value(obs: Observation, name: str) -> int:
    """An observed metric; 0 when the planner dropped the observed part because
    its input is known to be empty."""
    try:
        return int(obs.get.get(name) or 0)
    except Py4JJavaError as error:
        if "AssertionError" not in str(error):  # that is: no row of metrics was delivered
            raise
        return 0


class StageTaps:
    """Row counts of pipeline stages gathered *while* the pipeline runs.

    ``tap(stage, df, **metrics)`` returns ``df`` with an :class:`Observation`
    attached (a row count plus any named aggregate, e.g. unmatched lookups);
    the numbers are collected by whatever action executes the stage, so an
    audited report run costs no extra job.  :meth:`results` must be called
    after that action.
    """

    def __init__(self) -> None:
        self._observations: list[tuple[str, Observation, list[str]]] = []

    def __call__(self, stage: str, df: DataFrame, **metrics: Column) -> DataFrame:
        obs = Observation(stage)
        self._observations.append((stage, obs, ["rows", *metrics]))
        cols = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in metrics.items()]
        return df.observe(obs, *cols)

    def results(self) -> list[tuple[str, str, int]]:
        return [(stage, metric, observed_value(obs, metric))
                for stage, obs, names in self._observations for metric in names]


def no_tap(stage: str, df: DataFrame, **metrics: Column) -> DataFrame:
    return df
