"""CSV report sink: header, missing values as empty fields, doubled quotes.

Spark writes a folder of part files per target (one file per task, written in
parallel); nothing is funnelled through one task or the driver.  Doubles are
written in plain notation (``12345678.9``, never ``1.23456789E7``) with all
digits of Java's round-trip form, so a finite double read back is the same
double; NaN and infinities are written as those words.  Outer blanks and line
ends inside a field survive; a missing text and an empty one are both empty
fields.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.audit import observed_value
from ..session import delete_path, materialize, staging_scope

log = logging.getLogger(__name__)

CSV_OPTIONS = {
    "header": "true",
    "nullValue": "",
    "emptyValue": "",
    "quote": '"',
    "escape": '"',
    "dateFormat": "yyyy-MM-dd",
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
EMPTY_REPORT_NOTICE = "the report has a header and no rows"


# The report file names.
def ocr_file_name(rep_end: dt.date) -> str:
    return f"OCR_{rep_end.isoformat()}_modified.csv"


def acr_file_name(rep_start: dt.date, rep_end: dt.date) -> str:
    return f"ACR_{rep_start.isoformat()}_{rep_end.isoformat()}.csv"


def _without_exponent(text: Column) -> Column:
    sign, head, tail, exponent = (
        F.regexp_extract(text, r"^(-?)(\d+)\.(\d+)E(-?\d+)$", k) for k in range(1, 5))
    digits = F.concat(head, F.regexp_replace(tail, "0+$", ""))
    point = F.length(head) + exponent.try_cast("int")      # digits before the point
    plain = (F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
             .when(point >= F.length(digits), F.rpad(digits, point, "0"))
             .otherwise(F.concat_ws(".", F.substring(digits, F.lit(1), point),
                                    F.substring(digits, point + 1, F.length(digits)))))
    return F.concat(sign, plain)


def plain_number(c: Column) -> Column:
    """Double as plain-notation text with its round-trip digits."""
    text = c.cast("string")
    # the rare exponent is expanded inside a lambda, outside of the generated code
    return F.when(text.contains("E"), F.get(F.transform(F.array(text), _without_exponent), 0)) \
        .otherwise(F.regexp_replace(text, r"\.0$", ""))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    doubles = {f.name: plain_number(F.col(f"`{f.name}`")) for f in df.schema.fields
               if isinstance(f.dataType, T.DoubleType)}
    out = df.withColumns(doubles) if doubles else df
    out.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a report back with its declared schema (no inference pass)."""
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine="true").csv(path)


class Receipt(NamedTuple):
    """What was written: the rows, and a digest of their values that no order or partitioning changes."""

    rows: int
    digest: int


def row_digest(df: DataFrame) -> Column:
    """Aggregate: the sum of the rows' hashes; a repeated row counts each time.  A missing value
    differs from the values beside it, since the places of the missing ones are hashed, too."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    row = F.xxhash64(F.concat_ws("", *[c.isNull().cast("int").cast("string") for c in cols]), *cols)
    return F.sum(row.cast("decimal(38,0)"))


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), row_digest(df).alias("digest")), obs


def _receipt(obs: Observation) -> Receipt:
    return Receipt(observed_value(obs, "rows"), observed_value(obs, "digest"))


def put_in_place(spark: SparkSession, moves: Sequence[tuple[str, str]]) -> None:
    """Rename every written folder to its target: all of them, or none.

    What a target held stands aside until the last one is in place, and comes back if a
    rename fails.  A rename is one step on a file system with folders.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path

    def rename(a: str, b: str) -> None:
        fs = path(a).getFileSystem(spark._jsc.hadoopConfiguration())
        if path(b).getParent() is not None:
            fs.mkdirs(path(b).getParent())
        if not fs.rename(path(a), path(b)):
            raise OSError(f"cannot rename {a} to {b}")

    def there(a: str) -> bool:
        return path(a).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(a))

    undo: list[tuple[str, str]] = []
    old: list[str] = []
    try:
        for written, target in moves:
            if there(target):
                old.append(f"{target}.old-{uuid.uuid4().hex}")
                rename(target, old[-1])
                undo.append((old[-1], target))
            rename(written, target)
            undo.append((target, written))
    except BaseException:
        for a, b in reversed(undo):
            rename(a, b)
        raise
    for a in old:
        delete_path(spark, a)


def write_targets(df: DataFrame, targets: Sequence[str]) -> Receipt:
    """Write ``df`` to every target folder, all or none, and say what was written.

    The report plan runs once: straight beside a single target, or into a staged table in
    the shared folder from which a folder beside every target is written, deleted
    afterwards.  Rows and digest are observed on the way (no extra job), for the report
    and for each target; if a target's differ from the report's, nothing is put in place.
    Only then the folders take their targets' names (see :func:`put_in_place`), so a
    failure leaves every target as it was.
    """
    if not targets:
        raise ValueError("no target")
    if len(set(targets)) < len(targets):
        raise ValueError("a target is named twice")
    spark = df.sparkSession
    # any column name can be staged and observed: positions stand in for the report's names
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    beside = [f"{t.rstrip('/')}.writing-{uuid.uuid4().hex}" for t in targets]
    try:
        with staging_scope(spark):
            source, receipt = numbered, None
            if len(targets) > 1:
                observed, obs = _observed(numbered, "report")
                source = materialize(observed, "report")
                receipt = _receipt(obs)
            for target, folder in zip(targets, beside, strict=True):
                observed, obs = _observed(source, f"report-{folder}")
                write_csv(observed.toDF(*df.columns), folder)
                written = _receipt(obs)
                if receipt is not None and written != receipt:
                    raise OSError(f"{target}: wrote {written}, the report has {receipt}")
                receipt = written
        put_in_place(spark, list(zip(beside, targets, strict=True)))
    finally:
        for folder in beside:
            delete_path(spark, folder)   # nothing is there after a run that went well
    return receipt


def write_report(df: DataFrame, targets: Sequence[str]) -> int:
    """:func:`write_targets`; returns the row count.  An empty report still gets its header
    and a notice is logged."""
    rows = write_targets(df, targets).rows
    if rows == 0:
        log.warning("%s (%s)", EMPTY_REPORT_NOTICE, targets[0])
    return rows
