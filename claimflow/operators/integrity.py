"""Foreign keys that lead nowhere, for every relationship in one read of each object.

A relationship path follows a missing or dangling key to nulls without a word.  Each
object is read once: its foreign keys are unfolded to (relationship, key), reduced
map-side to distinct keys with their number of rows, and left-joined to the ids of the
parents, so only distinct keys meet them; a key that a third of the rows share is one
row of that join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relate import RELATIONSHIPS


def hop_integrity(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(object, relationship, parent, rows, null_keys, dangling_rows, dangling_keys, ambiguous_keys).

    ``rows``: rows of the object; ``null_keys``: rows without a key; ``dangling_rows`` and
    ``dangling_keys``: rows, and distinct keys, that no parent has; ``ambiguous_keys``: distinct
    keys that several parents have, which multiply the rows of a path.
    """
    out = None
    for name, relationships in RELATIONSHIPS.items():
        hops = F.array(*[F.struct(F.lit(rel).alias("relationship"), F.lit(parent).alias("parent"), F.col(fk).alias("key"))
                         for rel, (fk, parent) in relationships.items()])
        keys = tables[name].select(F.explode(hops).alias("h")).groupBy("h.relationship", "h.parent", "h.key").agg(
            F.count(F.lit(1)).alias("n"))
        ids = None
        for parent in sorted({p for _, p in relationships.values()}):
            held = tables[parent].select(F.lit(parent).alias("_parent"), F.col("id").alias("_id"))
            ids = held if ids is None else ids.unionByName(held)
        parents = ids.filter(F.col("_id").isNotNull()).groupBy("_parent", "_id").agg(F.count(F.lit(1)).alias("_n"))
        met = keys.join(parents, (F.col("parent") == F.col("_parent")) & (F.col("key") == F.col("_id")), "left")
        missing = F.col("key").isNull()
        dangling = ~missing & F.col("_n").isNull()
        found = met.groupBy("relationship", "parent").agg(
            F.sum("n").alias("rows"), F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("null_keys"),
            F.sum(F.when(dangling, F.col("n")).otherwise(0)).alias("dangling_rows"),
            F.count_if(dangling).alias("dangling_keys"), F.count_if(F.col("_n") > 1).alias("ambiguous_keys"))
        found = found.select(F.lit(name).alias("object"), *found.columns)
        out = found if out is None else out.unionByName(found)
    return out


def dangling_keys(tables: Mapping[str, DataFrame], name: str, relationship: str) -> DataFrame:
    """(key, rows): the keys of one relationship that no parent has."""
    fk, parent = RELATIONSHIPS[name][relationship]
    keys = tables[name].filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    ids = tables[parent].select(F.col("id").alias("key"))
    return keys.join(ids, "key", "left_anti")
