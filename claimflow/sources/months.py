"""Payments in one folder per release month, contributions with them, and what changed.

Both large objects lie in ``{root}/{object}/release_month=...``; a contribution lies in the
month of its payment, so a load that brings some months rewrites just those folders, and a
reader that wants some months opens just those files.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import date_column
from ..session import shuffles_removed

MONTH = "release_month"
OBJECTS = ("payment", "payment_contribution")


def write_months(tables: Mapping[str, DataFrame], root: str, months: Iterable[dt.date] | None = None) -> None:
    """Write both objects of ``tables`` by release month; with ``months`` only those folders,
    the others stay as they are.  Payments without a release date have a folder of their own,
    and so have contributions without a payment."""
    paid = tables["payment"]
    paid = paid.withColumn(MONTH, F.trunc(date_column(paid, "release"), "month"))
    # dealt by the id alone: the distinct months of an id and the join need no other exchange
    month_of = paid.select(F.col("id").alias("_payment"), F.col(MONTH)).repartition("_payment").distinct()
    facts = tables["payment_contribution"].drop(MONTH)
    facts = facts.join(month_of, F.col("payment_id") == F.col("_payment"), "left").drop("_payment")
    for name, df in zip(OBJECTS, (paid, facts), strict=True):
        if months is not None:
            df = df.filter(F.col(MONTH).isin(list(months)))
        # one task, or a few after a skew split, per month: few files a folder
        with shuffles_removed(df.sparkSession):
            (df.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if months is not None else "static")
             .option("compression", "zstd").partitionBy(MONTH).parquet(f"{root.rstrip('/')}/{name}"))


def read_months(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The two objects, with the column ``release_month`` to prune by."""
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{name}").withColumn(MONTH, F.col(MONTH).cast("date"))
            for name in OBJECTS}


def signatures(spark: SparkSession, root: str) -> dict[dt.date, str]:
    """A digest of the files (name, size, time) of each month's folders, from listings alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    found: dict[dt.date, list[str]] = {}
    for name in OBJECTS:
        top = path(f"{root.rstrip('/')}/{name}")
        fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in fs.listStatus(top):
            key, _, value = folder.getPath().getName().partition("=")
            if key != MONTH or value.startswith("__"):      # no release date: no processed payment
                continue
            files = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                           for f in fs.listStatus(folder.getPath()) if not f.getPath().getName().startswith(("_", ".")))
            found.setdefault(dt.date.fromisoformat(value), []).append(f"{name} {files}")
    return {month: hashlib.sha256("\n".join(parts).encode()).hexdigest() for month, parts in found.items()}
