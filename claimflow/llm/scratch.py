"""Staged tables: intermediate results written to the shared checkpoint folder.

A staged table cuts the lineage, survives the loss of any executor, gives its
readers column pruning and true sizes, and is deleted when its run is over.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from zipfile import ZipFile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import claimflow
from claimflow.session import delete_path, scratch_path

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's code to the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(claimflow.__file__).parent
    folder = tempfile.TemporaryDirectory(prefix="claimflow-code-")
    atexit.register(folder.cleanup)  # tasks may fetch the code until the application ends
    archive = f"{folder.name}/claimflow-code.zip"
    with ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"claimflow/{f.relative_to(package)}")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


class Scratch:
    """Staged tables of one operator run."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.tables: list[str] = []
        ship(spark)

    def path(self, name: str) -> str:
        """A fresh folder, deleted at the end of the run."""
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        return path

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; gone when the run ends."""
        return written(df, self.path(name))

    def stage_texts(self, df: DataFrame, name: str) -> DataFrame:
        """:meth:`stage` for a table of texts, packed tighter."""
        return written(df, self.path(name), "zstd")

    def stage_dealt(self, df: DataFrame, name: str, column: str, compression: str = "snappy") -> DataFrame:
        """:meth:`stage`, dealt to as many buckets of ``column`` as there are shuffle partitions.

        What is grouped or joined by ``column`` reads the buckets as they lie, without a shuffle.
        """
        table = f"{name}_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = self.path(name)
        self.tables.append(table)  # before the write: a failed one may leave the table too
        df.write.format("parquet").option("compression", compression).bucketBy(buckets, column).option("path", path).saveAsTable(table)
        return self.spark.table(table)

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """Write the run's (small) result and read it back; it outlives the run."""
        return written(df, scratch_path(self.spark, name))

    def drop(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()
        for path in self.paths:
            delete_path(self.spark, path)
        self.paths.clear()


def written(df: DataFrame, path: str, compression: str = "snappy") -> DataFrame:
    df.write.option("compression", compression).parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return df.sparkSession.read.schema(schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Staged tables for the block; deleted when it exits, also by an error."""
    run = Scratch(spark)
    try:
        yield run
    finally:
        run.drop()
