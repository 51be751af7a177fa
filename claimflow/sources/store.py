"""Facts stored where their joins need them.

Payment contributions and payments are the two large objects, 1:1 or nearly so, and
every report joins them on the payment id.  Stored in the same number of buckets of
that id, sorted by it, they are joined bucket by bucket: no exchange lies below that
join, at any size, and the first shuffle of a report carries what the filters left.

A store is a folder of the shared file system with one sub-folder per object and their
layout, so that any session can open it.  :func:`store_facts` writes to a fresh folder
and puts the layout in last: a store without it is not there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# object -> the column that it is bucketed and sorted by
BUCKET_COLUMNS = {"payment": "id", "payment_contribution": "payment_id"}
LAYOUT = "layout"
LAYOUT_SCHEMA = "object string, buckets int, schema string"


def store_facts(tables: Mapping[str, DataFrame], root: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """Store the large objects of ``tables`` under ``root``; returns ``tables`` reading from there.

    ``buckets`` defaults to the session's shuffle partitions: as many tasks join them.
    """
    spark = tables["payment"].sparkSession
    root = root.rstrip("/")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, column in BUCKET_COLUMNS.items():
        table = _table_name()
        (tables[name].repartition(buckets, column).write.format("parquet").mode("errorifexists")
         .bucketBy(buckets, column).sortBy(column).option("path", f"{root}/{name}").saveAsTable(table))
        spark.sql(f"DROP TABLE {table}")   # the files stay; open_facts registers them
    layout = [(name, buckets, tables[name].schema.json()) for name in BUCKET_COLUMNS]
    spark.createDataFrame(layout, LAYOUT_SCHEMA).write.parquet(f"{root}/{LAYOUT}")
    return {**tables, **open_facts(spark, root)}


def open_facts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The objects of a store, by name."""
    root = root.rstrip("/")
    out = {}
    for row in spark.read.schema(LAYOUT_SCHEMA).parquet(f"{root}/{LAYOUT}").toLocalIterator():
        name, column, table = row["object"], BUCKET_COLUMNS[row["object"]], _table_name()
        fields = T.StructType.fromJson(json.loads(row["schema"])).fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({column}) SORTED BY ({column}) "
                  f"INTO {row['buckets']} BUCKETS LOCATION '{root}/{name}'")
        out[name] = spark.table(table)
    # both sides lie sorted and bucketed alike: a merge is cheaper than a broadcast at any size
    out["payment"] = out["payment"].hint("merge")
    return out


def _table_name() -> str:
    return f"claimflow_fact_{uuid.uuid4().hex}"
