"""Approximate nearest neighbours by adaptive dimension scan over inverted lists.

Vectors are assigned to the nearest of a bounded number of centroids, which
gives the lists; a query probes the lists of its nearest centroids.  Within a
list, vectors and query are rotated at random and compared in blocks of
columns.  After each block a hypothesis test on the partial distance says
whether a candidate can still be among the nearest; most are given up after a
few columns.  What survives is measured exactly on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.llm.joins import lookup
from claimflow.llm.scratch import Scratch, scratch

NEIGHBOURS = 10
COLUMNS = 16            # of a block
EPSILON = 2.1           # of the test: larger gives up later
SAMPLE = 20_000         # vectors that the centroids are fitted on, at most
LISTS = 4096            # centroids, at most
PROBED = 0.65           # share of the lists that a query probes: near-random vectors need as many (README)
LEAST_SEEN = 1000       # candidates that the probed lists hold together, at least
BLOCK = 8192            # vectors of a list compared in one task
QUERIES = 1024          # queries of a list compared in one task


def usable(vector: Column) -> Column:
    """Neither null nor zero nor with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dims: int, seed: int = 17) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centroids(vectors: np.ndarray, count: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """k-means over a bounded sample."""
    rng = np.random.default_rng(seed)
    centres = vectors[rng.choice(len(vectors), min(count, len(vectors)), replace=False)]
    for _ in range(rounds):
        own = nearest(vectors, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        sizes = np.bincount(own, minlength=len(centres))
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def nearest(vectors: np.ndarray, centres: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest centroids of each vector, nearest first."""
    out = np.empty((len(vectors), min(count, len(centres))), np.int64)
    norms = (centres ** 2).sum(1)
    for lo in range(0, len(vectors), 1024):
        d = norms - 2 * vectors[lo:lo + 1024] @ centres.T
        if out.shape[1] == 1:
            out[lo:lo + 1024, 0] = d.argmin(1)
        else:
            out[lo:lo + 1024] = np.argsort(d, axis=1, kind="stable")[:, :out.shape[1]]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def scan(query: np.ndarray, rotated_query: np.ndarray, vectors: np.ndarray, blocks: list[np.ndarray],
         ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the ``count`` nearest of one list, nearest first.

    ``blocks`` are the rotated vectors in column blocks.  The first rows set the
    distance to beat; later rows are given up when their partial distance says,
    at the test's confidence, that the whole one is beyond it.
    """
    best_ids, best = np.zeros(0, np.int64), np.zeros(0)
    dims = len(query)
    for lo in range(0, len(vectors), 1024) if len(vectors) > 64 else [0]:
        starts = [(0, 64), (64, 1024)] if lo == 0 else [(lo, lo + 1024)]
        for a, b in starts:
            alive = np.arange(a, min(b, len(vectors)))
            bound = best[count - 1] if len(best) >= count else np.inf
            partial, seen = np.zeros(len(alive)), 0
            for block in blocks if np.isfinite(bound) else []:
                width = block.shape[1]
                partial = partial + ((block[alive] - rotated_query[seen:seen + width]) ** 2).sum(1)
                seen += width
                limit = bound * bound * seen / dims * (1 + EPSILON / np.sqrt(seen)) ** 2 if seen < dims \
                    else bound * bound * (1 + 1e-9)
                keep = partial <= limit
                alive, partial = alive[keep], partial[keep]
            if len(alive):
                exact = np.sqrt(((vectors[alive] - query) ** 2).sum(1))
                best_ids, best = np.concatenate([best_ids, ids[alive]]), np.concatenate([best, exact])
                order = np.lexsort((best_ids, best))[:count]
                best_ids, best = best_ids[order], best[order]
    return best_ids, best


def search(run: Scratch, table: DataFrame, queries: Column, count: int = NEIGHBOURS,
           probed: float = PROBED) -> DataFrame:
    """The ``count`` nearest other rows of each row of ``table`` that ``queries`` marks.

    ``table`` has vec_id and embedding; returns query_id, rank, vec_id, score
    (the Euclidean distance in double precision).  Ties go to the smaller vec_id.
    Equal vectors are one candidate: they keep their ``count + 1`` smallest ids,
    which is all that any answer can use.  Vectors that are null, zero or hold a
    null or non-finite component take no part, nor do those of another length
    than most, nor null ids; rows that repeat a vec_id and vector count once.
    Fewer candidates than ``count`` give as many rows; an empty table gives none.
    """
    spark = run.spark
    valid = table.select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.col("embedding").cast("array<double>").alias("embedding"),
                         F.coalesce(queries, F.lit(False)).alias("asks")) \
        .filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    lengths = valid.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if top is None:
        return empty
    dims = top["d"]
    # one row per vector and id; the grouping below keeps the smallest ids of each vector
    rows = run.stage(valid.filter(F.size("embedding") == dims).groupBy("vec_id", "embedding")
                     .agg(F.max("asks").alias("asks")), "rows")
    by_id = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    members = rows.withColumn("at", by_id).filter(F.col("at") <= count + 1)
    classes = run.stage(members.groupBy("embedding").agg(
        F.min("vec_id").alias("class_id"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "classes")
    asked = run.stage(rows.filter("asks").select(F.col("vec_id").alias("query_id"), "embedding"), "asked")
    weights = asked.groupBy("embedding").agg(F.count("*").alias("n"))
    asking = run.stage(classes.select("embedding", "class_id").join(weights, "embedding"), "asking")

    total = classes.count()
    sampled = classes.select("embedding").orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE)
    lists = int(min(LISTS, max(1, np.sqrt(total))))
    centres = _fitted(sampled, lists, dims)
    assigned = run.stage(_assigned(classes.select("class_id", "embedding"), centres, 1), "assigned")
    sizes = {r["list"]: r["n"] for r in assigned.groupBy("list").agg(F.count("*").alias("n")).collect()}
    per_query = _probes(asking.select("class_id", "embedding"), centres, sizes, max(1, int(np.ceil(probed * lists))))
    probes = run.stage(per_query.withColumnRenamed("class_id", "query"), "probes")
    asks = probes.groupBy("list").agg(F.count("*").alias("q"))
    plan = run.stage(assigned.groupBy("list").agg(F.count("*").alias("n")).join(asks, "list").select(
        "list", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.col("q") / QUERIES).cast("int").alias("parts")), "plan")
    plan = F.broadcast(plan)  # at most LISTS rows
    vectors = assigned.join(plan, "list").select(
        "list", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "class_id", "embedding")
    wanted = probes.join(plan, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("query"), F.col("parts")).cast("int").alias("part"), "query", "embedding")

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            data, ids = _matrix(right.column("embedding")), right.column("class_id").to_numpy()
            turn = rotation(dims)
            turned = data @ turn
            blocks = [np.ascontiguousarray(turned[:, c:c + COLUMNS]) for c in range(0, dims, COLUMNS)]
            asking_ = _matrix(left.column("embedding"))
            for query, q, r in zip(left.column("query").to_pylist(), asking_, asking_ @ turn, strict=True):
                found, score = scan(q, r, data, blocks, ids, count + 1)
                out[0] += [query] * len(found)
                out[1] += found.tolist()
                out[2] += score.tolist()
        return pa.table({"query": pa.array(out[0], pa.int64()), "class_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})

    found = wanted.groupBy("list", "block", "part").cogroup(vectors.groupBy("list", "block", "part")).applyInArrow(
        compare, "query long, class_id long, score double")
    nearest_classes = F.row_number().over(Window.partitionBy("query").orderBy("score", "class_id"))
    found = found.withColumn("at", nearest_classes).filter(F.col("at") <= count + 1)
    each = found.join(classes.select("class_id", "ids"), "class_id").select(
        "query", "score", F.explode("ids").alias("vec_id"))
    by_distance = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    each = each.withColumn("at", by_distance).filter(F.col("at") <= count + 1)
    answers = each.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("answers"))
    answers = run.stage(asking.select("embedding", F.col("class_id").alias("query"), "n").join(answers, "query")
                        .select("embedding", "answers", "n"), "answers")
    own = lookup(asked, answers, ["embedding"], "n").select("query_id", F.slice(F.filter(
        "answers", lambda a: a["vec_id"] != F.col("query_id")), 1, count).alias("answers"))
    return own.select("query_id", F.posexplode("answers").alias("rank", "a")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), "a.vec_id", "a.score")


def _fitted(sample: DataFrame, lists: int, dims: int) -> np.ndarray:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_matrix(b.column(0)) for b in batches if b.num_rows]
        found = centroids(np.concatenate(parts), lists)
        yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["centres"])

    # at most SAMPLE vectors go to the one task, at most LISTS centroids to the driver
    row = sample.repartition(1).mapInArrow(fit, "centres binary").first()
    return np.frombuffer(row["centres"]).reshape(-1, dims)


def _assigned(vectors: DataFrame, centres: np.ndarray, count: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = nearest(_matrix(batch.column(1)), shared.value, count)[:, 0]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own.astype(np.int32))],
                                                 ["class_id", "embedding", "list"])

    return vectors.mapInArrow(assign, "class_id long, embedding array<double>, list int")


def _probes(queries: DataFrame, centres: np.ndarray, sizes: dict[int, int], probed: int) -> DataFrame:
    held = np.array([sizes.get(k, 0) for k in range(len(centres))], np.int64)
    shared = queries.sparkSession.sparkContext.broadcast((centres, held))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = nearest(_matrix(batch.column(1)), shared.value[0], len(centres))
                before = np.cumsum(shared.value[1][near], axis=1) - shared.value[1][near]
                taken = (np.arange(near.shape[1]) < probed) | (before < LEAST_SEEN)
                row, column = np.nonzero(taken)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
                     pa.array(near[row, column].astype(np.int32))], ["class_id", "embedding", "list"])

    return queries.mapInArrow(probe, "class_id long, embedding array<double>, list int")


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest other vectors of each vector whose id is divisible by 100."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    with scratch(spark) as run:
        return run.result(search(run, table, F.col("vec_id") % 100 == 0), "op8")
