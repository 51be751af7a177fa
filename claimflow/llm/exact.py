"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest.  A batch of documents is
digested once, reduced to one row per digest, and deduplicated against the
index by a sort-merge anti-join that reads the index bucket by bucket without
shuffling it; what is new is appended.  DataFrame and SQL functions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.joins import lookup
from claimflow.llm.scratch import Scratch, scratch

SPACES = r"[\x20\x09-\x0D]+"
BATCHES = 2             # of documents, that the query feeds to the index


def normalised(text: Column) -> Column:
    """The text with every run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(F.encode(normalised(text), "utf-8"), 256))


class DigestIndex:
    """A table (digest, keep_id, since) bucketed and sorted by digest.

    ``keep_id`` is the id of the row that stays for the digest, ``since`` the
    batch that brought it.  With ``path`` the files live there and a session
    with an empty catalog finds them again; else the warehouse holds them.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int, path: str | None = None):
        self.spark, self.table, self.buckets, self.path = spark, table, buckets, path

    def open(self) -> DigestIndex:
        """Create the table, or register the files that ``path`` holds."""
        where = f"LOCATION '{self.path}'" if self.path else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, since STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS {where}")
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, digests: DataFrame) -> DataFrame:
        """The rows of ``digests`` whose digest the index lacks."""
        return digests.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, fresh: DataFrame, since: str) -> None:
        (fresh.select("digest", "keep_id", F.lit(since).alias("since"))
         .repartition(self.buckets, "digest")
         .write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest")
         .options(**({"path": self.path} if self.path else {})).saveAsTable(self.table))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def dedup(run: Scratch, docs: DataFrame, index: DigestIndex, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Deduplicate a batch against ``index`` and append what is new.

    Returns a staged table with one row per row of ``docs``: ``doc_id``,
    ``digest``, ``keep_id`` (the id that stays for the text), ``group_size``
    (rows of this batch with the text), ``kept``, and ``repeats`` (rows of the
    batch with the same id and text, of which one is kept).

    Two texts are equal when they are the same after each run of ASCII white
    space becomes one space; a null text counts as empty.  Of equal texts the
    smallest id stays, a null id only if there is no other.  A text that the
    index held before the batch keeps nothing here.  Rows that repeat both id
    and text are one document: ``kept`` is true on one of them.  Other columns
    are not read, so their names cannot clash; an empty batch gives no rows.
    """
    rows = run.stage(docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest"),
                                 F.monotonically_increasing_id().alias("at")), "digests")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at"))
    groups = run.stage(
        rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size"))
        .select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.at").alias("keep_at"),
                "group_size", F.col("group_size").alias("n")), "groups")
    batch = uuid.uuid4().hex
    index.append(index.unseen(groups), batch)
    known = index.read().select("digest", F.col("keep_id").alias("known_id"), "since")
    groups = run.stage(
        groups.join(known, "digest").select(
            "digest", "n", "group_size",
            F.when(F.col("since") == batch, F.col("keep_id")).otherwise(F.col("known_id")).alias("keep_id"),
            F.when(F.col("since") == batch, F.col("keep_at")).alias("keep_at")), "decided")
    found = lookup(rows, groups, ["digest"], "n")
    return found.select("doc_id", "digest", "keep_id", "group_size",
                        F.coalesce(F.col("at") == F.col("keep_at"), F.lit(False)).alias("kept"))


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the warehouse, as many buckets as shuffle partitions."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", buckets).open()


def dedup_batches(run: Scratch, docs: DataFrame, index: DigestIndex, batches: int = BATCHES) -> DataFrame:
    """:func:`dedup` of ``docs`` in batches of rising doc_id, null ids last.

    Each batch meets what those before it left in the index.  ``group_size`` counts
    the rows with the text in all batches.
    """
    cuts = sorted(set(docs.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01)))
    rows, doc_id = None, F.col("doc_id")
    for lo, hi in zip([None, *cuts], [*cuts, None], strict=True):
        inside = F.lit(True) if lo is None else doc_id > lo
        inside = inside | doc_id.isNull() if hi is None else inside & (doc_id <= hi)
        found = run.stage(dedup(run, docs.filter(inside), index), "batch")
        rows = found if rows is None else rows.unionByName(found)
    sizes = run.stage(rows.groupBy("digest").agg(F.sum(F.lit(1)).alias("group_size")).withColumn(
        "n", F.col("group_size")), "sizes")
    return lookup(rows.drop("group_size"), sizes, ["digest"], "n")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = new_index(spark)
    try:
        with scratch(spark) as run:
            out = dedup_batches(run, docs, index).select(
                "doc_id", "keep_id", "group_size", "kept",
                F.lower(F.hex("digest")).alias("text_sha256"))
            return run.result(out, "op4")
    finally:
        index.drop()


OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t
"""


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents whose row stays, all columns.

    The dropped ids are few beside the documents, so they are anti-joined.  A
    row whose id and text both repeat stays once.
    """
    index = new_index(spark)
    try:
        with scratch(spark) as run:
            decided = run.stage(dedup(run, docs, index).select("doc_id", "digest", "keep_id", "kept"), "decided")
            same_id = F.col("doc_id").eqNullSafe(F.col("keep_id"))
            dropped = run.result(decided.filter(~same_id).select("doc_id", "digest"), "dropped")
            repeated = decided.filter(same_id & ~F.col("kept")).limit(1).count() > 0
            # an id may come with several texts, some of which stay: then the digest decides too
            by_text = dropped.join(decided.filter(same_id), "doc_id", "left_semi").limit(1).count() > 0
    finally:
        index.drop()
    # positions stand in for the documents' names, so that none of them can clash
    at = {c: f"c{docs.columns.index(c)}" for c in ("doc_id", "text")}
    rows = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    columns = rows.columns
    if by_text or repeated:
        rows = rows.withColumn("digest", digest(F.col(at["text"])))
    nulls = dropped.filter("doc_id IS NULL").limit(1).count() > 0
    gone = rows[at["doc_id"]].eqNullSafe(dropped["doc_id"]) if nulls else rows[at["doc_id"]] == dropped["doc_id"]
    if by_text or repeated:
        gone = gone & (rows["digest"] == dropped["digest"])
    kept = rows.join(dropped.hint("merge"), gone, "left_anti")
    if repeated:
        kept = kept.dropDuplicates([at["doc_id"], "digest"])
    return kept.select(*columns).toDF(*docs.columns)
