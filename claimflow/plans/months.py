"""Payment rollup states kept between runs, one set per release month.

A run compares the files of each month with what the states were made of, reads the
months that changed, and merges their states with the kept ones: the history is not read
again.  States are the partial states of the rollup per benefit claimed, so merging them is
exact (see :mod:`claimflow.operators.rollup`).

``{root}/states-*`` hold states, one folder per computing run and in it one per month;
``{root}/manifest-<n>`` says for each month which folder holds it and what it was made of.
A manifest is written last and counts once it is whole, so a run that dies, or is
repeated, changes nothing but leftover folders, which the next whole run deletes.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import as_date, as_number
from ..operators import predicates as P
from ..operators.rollup import finish, merged, states
from ..session import delete_path, shuffles_removed
from ..sources.months import MONTH, read_months, signatures
from .lookups import _group_parents

MANIFEST_SCHEMA = "month date, signature string, folder string"
PARTS = 16    # tasks that share a month, and files of its states, at most
PART = "_part"
PAID_COLUMNS = ("benefit_claimed_id", "amount", "start", "through", "release", "line_number")
STATE_COLUMNS = ("n", "n_amount", "n_exact", "exact", "total", "n_first", "n_last", "n_release", "first", "last", "eff",
                 "pick", "pick_at")


def month_end(month: dt.date) -> dt.date:
    return (month + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)


def states_of_months(tables: Mapping[str, DataFrame], months: list[dt.date],
                     until: dt.date | None = None) -> DataFrame:
    """States of processed payments per (release_month, benefit_claimed_id), of some months only.

    Both objects are pruned to the months' folders before they are joined.
    """
    wanted = F.col(MONTH).isin(months)
    paid = as_date(tables["payment"].filter(wanted), ["release"])
    last = until or max(months, default=dt.date(9999, 12, 1)).replace(day=28) + dt.timedelta(days=31)
    paid = paid.filter(P.processed_by(F.col("status"), F.col("release"), last)).select(
        F.col("id").alias("_payment"), "release")
    pc = tables["payment_contribution"].filter(wanted)
    pc = as_date(as_number(pc, ["amount"]), ["start", "through"])
    pc = pc.select(MONTH, "benefit_claimed_id", "payment_id", "line_number", "amount", "start", "through")
    joined = pc.join(paid, pc["payment_id"] == paid["_payment"])
    # dealt once, by month and part, as narrow rows: both steps of the rollup and the files per month
    # need no other exchange, and a month is the work of up to PARTS tasks
    tasks = int(joined.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = joined.select(MONTH, F.pmod(F.xxhash64("benefit_claimed_id"), F.lit(PARTS)).alias(PART), *PAID_COLUMNS) \
        .repartition(tasks, MONTH, PART)
    return states(dealt, [MONTH, PART, "benefit_claimed_id"], *[F.col(c) for c in PAID_COLUMNS[1:]]).drop(PART)


class MonthStates:
    """The states under ``root``, made of the months under ``source`` (see :mod:`claimflow.sources.months`)."""

    def __init__(self, spark: SparkSession, root: str, source: str):
        self.spark, self.root, self.source = spark, root.rstrip("/"), source

    def _entries(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def _whole(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def manifest(self) -> tuple[int, dict[dt.date, tuple[str, str]]]:
        """Number of the last whole manifest and its months: (signature, folder)."""
        numbers = [int(m[1]) for m in (re.fullmatch(r"manifest-(\d+)", e) for e in self._entries()) if m]
        for number in sorted(numbers, reverse=True):
            if self._whole(f"manifest-{number}"):
                rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.root}/manifest-{number}")
                return number, {r["month"]: (r["signature"], r["folder"]) for r in rows.toLocalIterator()}  # one row a month
        return 0, {}

    def update(self) -> list[dt.date]:
        """Bring the states up to date with the source; returns the months that were read."""
        number, known = self.manifest()
        now = signatures(self.spark, self.source)
        changed = sorted(m for m, s in now.items() if known.get(m, ("",))[0] != s)
        if not changed and known.keys() == now.keys():
            return []
        kept = {m: v for m, v in known.items() if m in now and m not in changed}
        if changed:
            folder = f"states-{uuid.uuid4().hex}"
            with shuffles_removed(self.spark):
                (states_of_months(read_months(self.spark, self.source), changed)
                 .write.option("compression", "zstd").partitionBy(MONTH).parquet(f"{self.root}/{folder}"))
            kept |= {m: (now[m], folder) for m in changed}
        rows = [(m, *v) for m, v in sorted(kept.items())]
        # a manifest that a dead run left half written is written anew
        (self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/manifest-{number + 1}"))
        self._tidy(number + 1, {f for _, f in kept.values()})
        return changed

    def _tidy(self, number: int, folders: set[str]) -> None:
        """Delete what no manifest names, but for the manifest before and its folders' months."""
        for entry in self._entries():
            old = re.fullmatch(r"manifest-(\d+)", entry)
            if (old and int(old[1]) < number) or (entry.startswith("states-") and entry not in folders):
                delete_path(self.spark, f"{self.root}/{entry}")

    def read(self, rep_end: dt.date) -> DataFrame:
        """States of payments released up to ``rep_end``, per month and benefit claimed.

        Whole months come from the kept states, a month that ``rep_end`` cuts from the source.
        """
        _, known = self.manifest()
        paths = [f"{self.root}/{folder}/{MONTH}={month.isoformat()}" for month, (_, folder) in sorted(known.items())
                 if month_end(month) <= rep_end]
        tables = read_months(self.spark, self.source)
        cut = [m for m in known if m <= rep_end < month_end(m)]
        fresh = states_of_months(tables, cut, rep_end).select("benefit_claimed_id", *STATE_COLUMNS)
        # a month of payments that are not processed has no states and no folder
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsc.hadoopConfiguration()
        paths = [p for p in paths if path(p).getFileSystem(conf).exists(path(p))]
        if not paths:
            return fresh
        kept = self.spark.read.schema(fresh.schema).parquet(*paths)
        return kept.unionByName(fresh) if cut else kept


def rollup_of_months(tables: Mapping[str, DataFrame], kept: MonthStates, rep_end: dt.date) -> DataFrame:
    """The payment rollup by benefit-claimed name from kept states; ``tables`` give the parents.

    The states of all months are dealt once by their benefit, where they become one before
    they meet the parents: what is merged by name grows with the benefits and not the months.
    """
    parents = _group_parents(tables, "benefit_claimed", "name", "claim.business_type", "benefit_claimed_name")
    months = merged(kept.read(rep_end).repartition("benefit_claimed_id"), ["benefit_claimed_id"])
    joined = months.join(parents, months["benefit_claimed_id"] == parents["_id"])
    return finish(merged(joined, ["benefit_claimed_name"]), "benefit_claimed_name")
