"""Hard negatives by a GNAT-style multiway hyperplane tree.

A node of the tree has several split points; a vector belongs to the nearest one,
so that hyperplanes divide the siblings.  Each split point stores the smallest and
largest distance to the vectors of each sibling's subtree.  A query looks for
scores (inner products) in a window; with the lengths of a subtree's vectors that
is a ring of distances around the query, and a sibling is eliminated when the
distances that some split point allows do not meet the ring.  What is left is
scored exactly, so the answers are exact.

The split points are chosen on a bounded sample; every vector goes down the tree,
and the distance ranges are taken over all of them.  A search runs twice: in the
group of leaves that the query itself belongs to, which gives a score to beat, and
then in all leaves that the narrowed window leaves over.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.llm.joins import lookup
from claimflow.llm.scratch import Scratch, scratch

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90         # percent of the positive's score that a negative's may have
SCALE = 256                # a component x counts as floor(SCALE * x)
LARGEST = 1 << 25          # of a component, either way: scores are exact in 64 bits
ARITY = 16                 # split points of a node
LEVELS = 3                 # of split points, at most: ARITY ** LEVELS leaves
SAMPLE = 20_000            # vectors that the split points are chosen from, at most
LEAST_NODE = 4 * ARITY     # sampled vectors that a node is split for
GROUP = (512, 65_536)      # vectors of a group of leaves, at least and at most
GROUPS = 64                # groups, about, between those bounds
QUERIES = 4096             # queries that meet a group in one task, about
ROWS = 256                 # queries scored at once


def whole_numbers(vector: Column) -> Column:
    """``floor(SCALE * x)`` of each component; null if the vector or one of them is null or non-finite."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(F.floor(v * SCALE)) > LARGEST))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v * SCALE).cast("int")))


class Tree(NamedTuple):
    pivots: np.ndarray      # (split points, dimensions)
    first: np.ndarray       # of each node: its first split point
    count: np.ndarray       # of each node: how many it has
    below: np.ndarray       # of each split point: the node of its subtree, or -1 - leaf
    leaves: int


class Ranges(NamedTuple):
    """Distances from a split point to a sibling's subtree, and a subtree's squared lengths."""

    near: np.ndarray        # (split point of the subtree, place of the sibling that measures)
    far: np.ndarray
    shortest: np.ndarray
    longest: np.ndarray


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of 32-bit numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), dims).astype(np.float64)


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (rows ** 2).sum(1)[:, None] + (points ** 2).sum(1) - 2 * rows @ points.T
    return np.sqrt(np.maximum(square, 0))


def grow(vectors: np.ndarray, levels: int) -> Tree:
    """The split points of a sample: in each node the ones that lie far from each other."""
    pivots, first, count, below, leaves = [], [], [], [], 0
    todo = [(vectors, 0, -1)]
    while todo:
        rows, level, above = todo.pop(0)
        chosen = _far_apart(rows) if level < levels and (len(rows) >= LEAST_NODE or above < 0) else rows[:0]
        if len(chosen) < 2 and above >= 0:
            below[above] = -1 - leaves
            leaves += 1
            continue
        if above >= 0:
            below[above] = len(first)
        start = len(below)
        first.append(start)
        count.append(len(chosen))
        pivots += list(chosen)
        below += [0] * len(chosen)
        own = distances(rows, chosen).argmin(1)
        todo += [(rows[own == k], level + 1, start + k) for k in range(len(chosen))]
    return Tree(np.array(pivots).reshape(len(below), vectors.shape[1]), np.array(first), np.array(count),
                np.array(below), leaves)


def _far_apart(rows: np.ndarray) -> np.ndarray:
    chosen = [0]
    least = distances(rows, rows[:1])[:, 0]
    while len(chosen) < min(ARITY, len(rows)) and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def descend(tree: Tree, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(node, its rows, their distances to its split points, the split points they belong to)."""
    todo = [(0, np.arange(len(rows)))]
    while todo:
        node, mine = todo.pop()
        lo = int(tree.first[node])
        to = distances(rows[mine], tree.pivots[lo:lo + int(tree.count[node])])
        own = lo + to.argmin(1)
        yield node, mine, to, own
        for split in np.unique(own).tolist():
            if tree.below[split] >= 0:
                todo.append((int(tree.below[split]), mine[own == split]))


def leaf_of(tree: Tree, rows: np.ndarray) -> np.ndarray:
    leaf = np.zeros(len(rows), np.int32)
    for _, mine, _, own in descend(tree, rows):
        at = tree.below[own]
        leaf[mine[at < 0]] = -1 - at[at < 0]
    return leaf


def survivors(tree: Tree, ranges: Ranges, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which leaves can hold a vector whose score with a row is in one of the row's windows.

    ``low``, ``high``: (rows, windows).  Returns (rows, leaves).
    """
    out = np.zeros((len(rows), tree.leaves), bool)
    square = (rows ** 2).sum(1)
    todo = [(0, np.arange(len(rows)))]
    while todo:
        node, mine = todo.pop()
        lo, n = int(tree.first[node]), int(tree.count[node])
        to = distances(rows[mine], tree.pivots[lo:lo + n])
        for split in range(lo, lo + n):
            if ranges.longest[split] < 0:   # nothing below
                continue
            least, most = ranges.near[split, :n], ranges.far[split, :n]
            # distances that every sibling allows between the row and the subtree
            near = np.maximum(np.maximum(least - to, to - most).max(1), 0)
            far = (to + most).min(1)
            slack = 1e-6 * (np.sqrt(square[mine]) + np.sqrt(ranges.longest[split]) + 1)
            near, far = np.maximum(near - slack, 0), far + slack
            outer = (square[mine] + ranges.longest[split])[:, None] - 2 * low[mine]
            inner = (square[mine] + ranges.shortest[split])[:, None] - 2 * high[mine]
            slack = (slack ** 2)[:, None]
            meets = ((near ** 2)[:, None] <= outer + slack) & ((far ** 2)[:, None] >= inner - slack)
            left = mine[(meets & (low[mine] <= high[mine])).any(1)]
            if tree.below[split] < 0:
                out[left, -1 - tree.below[split]] = True
            elif len(left):
                todo.append((int(tree.below[split]), left))
    return out


class Index:
    """All vectors of one length, in the leaves of a tree."""

    def __init__(self, run: Scratch, classes: DataFrame, dims: int):
        """``classes``: class, label, first_id, ids (array of long), vector (array of int)."""
        self.run, self.dims, spark = run, dims, run.spark
        packed = "class long, label long, first_id long, ids binary, vector binary"

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:3], *(_packed(b.column(k), t) for k, t in ((3, "<i8"), (4, "<i4")))],
                    ["class", "label", "first_id", "ids", "vector"])

        rows = run.stage(classes.select("class", "label", "first_id", "ids", "vector").mapInArrow(pack, packed), "packed")
        total = rows.count()
        levels = int(min(LEVELS, max(1, np.ceil(np.log(max(total, 2)) / 2 / np.log(ARITY)))))
        self.tree = self._grown(rows.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("vector"), levels)
        shared = spark.sparkContext.broadcast(self.tree)  # at most ARITY ** LEVELS split points, and as many again

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                leaf = leaf_of(shared.value, _matrix(b.column(4), dims))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], [*b.schema.names, "leaf"])

        placed = run.stage(rows.mapInArrow(place, f"{packed}, leaf int"), "placed")
        self.ranges = self._measured(placed)
        sizes = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
        # leaves next to each other make a group; a large leaf is cut into groups of its own
        goal = int(min(max(total // GROUPS, GROUP[0]), GROUP[1]))
        group, held, plan = 0, 0, []
        for leaf in range(self.tree.leaves):
            n = sizes.get(leaf, 0)
            blocks = max(1, -(-n // goal))
            if held and (held + n > goal or blocks > 1):
                group, held = group + 1, 0
            plan.append((leaf, group, blocks))
            if blocks > 1:
                group += blocks
            else:
                held += n
        self.plan = np.array(plan, np.int64)
        leaves = F.broadcast(spark.createDataFrame(plan, "leaf int, first int, blocks int"))
        self.vectors = run.stage(placed.join(leaves, "leaf").withColumn(
            "grp", (F.col("first") + F.pmod(F.xxhash64("class"), F.col("blocks"))).cast("int")).drop("first", "blocks"), "vectors")

    def _grown(self, sample: DataFrame, levels: int) -> Tree:
        dims = self.dims

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [_matrix(b.column(0), dims) for b in batches if b.num_rows]
            tree = grow(np.concatenate(parts), levels)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in (tree.pivots, *(y.astype(np.int64) for y in tree[1:4]))]
                + [pa.array([tree.leaves], pa.int64())], ["pivots", "first", "count", "below", "leaves"])

        # at most SAMPLE vectors go to the one task, at most ARITY ** LEVELS split points or so to the driver
        row = sample.repartition(1).mapInArrow(
            fit, "pivots binary, first binary, count binary, below binary, leaves long").first()
        first, count, below = (np.frombuffer(row[c], np.int64) for c in ("first", "count", "below"))
        return Tree(np.frombuffer(row["pivots"]).reshape(len(below), dims), first, count, below, row["leaves"])

    def _measured(self, placed: DataFrame) -> Ranges:
        """The ranges over all vectors: each task's smallest and largest, then those of all tasks."""
        dims, shared = self.dims, placed.sparkSession.sparkContext.broadcast(self.tree)

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = shared.value
            n = len(tree.below)
            low, high = np.full((n, ARITY + 1), np.inf), np.full((n, ARITY + 1), -np.inf)
            for b in batches:
                rows = _matrix(b.column(0), dims)
                square = (rows ** 2).sum(1)
                for _, mine, to, own in descend(tree, rows):
                    values = np.full((len(mine), ARITY + 1), np.nan)
                    values[:, :to.shape[1]] = to
                    values[:, ARITY] = square[mine]
                    np.fmin.at(low, own, values)
                    np.fmax.at(high, own, values)
            split, place = np.nonzero(np.isfinite(low))
            yield pa.RecordBatch.from_arrays(
                [pa.array(split.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(low[split, place]),
                 pa.array(high[split, place])], ["split", "place", "low", "high"])

        found = placed.select("vector").mapInArrow(measure, "split int, place int, low double, high double").groupBy(
            "split", "place").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        n = len(self.tree.below)
        low, high = np.full((n, ARITY + 1), np.inf), np.full((n, ARITY + 1), -np.inf)
        for r in found.toLocalIterator():  # one row per split point and sibling
            low[r["split"], r["place"]], high[r["split"], r["place"]] = r["low"], r["high"]
        return Ranges(low[:, :ARITY], high[:, :ARITY], low[:, ARITY], high[:, ARITY])

    def search(self, queries: DataFrame, count: int, same: bool, low: int = 0, high: int = 0, name: str = "") -> DataFrame:
        """The first ``count`` classes of each window of each query: query, at, score, class, first_id, ids.

        ``queries``: query (its class), label, vector, grp, and ``scores`` (array of long), one
        per window.  With ``same`` the window is every score with rows of the query's label, else
        ``low`` to ``high`` percent of its score with rows of other labels.  The classes come by
        score, largest first, ties by ``first_id``; ``at`` is the place in ``scores``.
        """
        queries = queries.withColumn("beat", F.array().cast("array<struct<at:int,score:bigint>>"))
        home = self.run.stage(self._probe(queries, count, same, low, high, True), f"{name}-home")
        beat = home.groupBy("query", "at").agg(F.count("*").alias("n"), F.min("score").alias("score")).filter(
            F.col("n") >= count).groupBy("query").agg(F.collect_list(F.struct("at", "score")).alias("beat"))
        narrowed = queries.drop("beat").join(beat, "query", "left").withColumn(
            "beat", F.coalesce("beat", F.array().cast("array<struct<at:int,score:bigint>>")))
        found = self._probe(self.run.stage(narrowed, f"{name}-asked"), count, same, low, high, False)
        order = Window.partitionBy("query", "at").orderBy(F.desc("score"), "first_id", "class")
        return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= count)

    def _probe(self, queries: DataFrame, count: int, same: bool, low: int, high: int, home: bool) -> DataFrame:
        parts = max(1, -(-queries.count() // QUERIES))
        dims, plan = self.dims, self.plan
        shared = queries.sparkSession.sparkContext.broadcast((self.tree, self.ranges))

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, ranges = shared.value
            for b in batches:
                for lo in range(0, b.num_rows, ROWS):
                    yield _spread(b.slice(lo, ROWS), tree, ranges, dims, plan, (same, low, high, home))

        asked = queries.select("query", "label", "vector", "grp", "scores", "beat").mapInArrow(
            spread, "grp int, query long, label long, vector binary, low array<long>, high array<long>, leaves binary")
        asked = asked.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
        vectors = self.vectors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

        def compare(left: pa.Table, right: pa.Table) -> pa.Table:
            out = [[], [], [], [], [], []]
            if left.num_rows and right.num_rows:
                _compare(left, right, dims, count, same, out)
            return pa.table(dict(zip(("query", "at", "score", "class", "first_id"), (
                pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()),
                                               strict=False)), strict=True))
                            | {"ids": pa.array(out[5], pa.list_(pa.int64()))})

        return asked.groupBy("grp", "part").cogroup(vectors.groupBy("grp", "part")).applyInArrow(
            compare, "query long, at int, score long, class long, first_id long, ids array<long>")


def _packed(column: pa.Array, kind: str) -> pa.Array:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(ends * values.itemsize), pa.py_buffer(
        values.tobytes())]).cast(pa.binary())


def _windows(scores: list[list[int]], beat: list[list[dict]], asks: tuple) -> tuple[list[list[int]], list[list[int]]]:
    """The windows of each query as whole numbers, narrowed by the score to beat."""
    same, low, high, _ = asks
    lows, highs = [], []
    for own, best in zip(scores, beat, strict=True):
        a = [-(1 << 62)] * len(own) if same else [-(-low * s // 100) for s in own]
        z = [1 << 62] * len(own) if same else [high * s // 100 for s in own]
        for b in best:
            a[b["at"]] = max(a[b["at"]], b["score"])
        lows.append(a)
        highs.append(z)
    return lows, highs


def _spread(b: pa.RecordBatch, tree: Tree, ranges: Ranges, dims: int, plan: np.ndarray, asks: tuple) -> pa.RecordBatch:
    """A row for each query and group that it has to look at, with the leaves."""
    low, high = _windows(b.column(4).to_pylist(), b.column(5).to_pylist(), asks)
    rows, groups, leaves = [], [], []
    if asks[3]:
        rows, groups = list(range(b.num_rows)), b.column(3).to_pylist()
        leaves = [b""] * len(rows)   # all of the group
    else:
        most = max(map(len, low), default=0)
        # a window that is none fills the rows up
        wide = [np.array([x + [fill] * (most - len(x)) for x in xs], np.float64).reshape(b.num_rows, most)
                for xs, fill in ((low, 1), (high, 0))]
        alive = survivors(tree, ranges, _matrix(b.column(2), dims), *wide)
        for k in range(b.num_rows):
            mine: dict[int, list[int]] = {}
            for leaf in np.flatnonzero(alive[k]).tolist():
                _, first, blocks = plan[leaf].tolist()
                for g in range(first, first + blocks):
                    mine.setdefault(g, []).append(leaf)
            rows += [k] * len(mine)
            groups += mine
            leaves += [np.array(x, np.int32).tobytes() for x in mine.values()]
    at = pa.array(rows, pa.int64())
    lists = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(groups, pa.int32()), b.column(0).take(at), b.column(1).take(at), b.column(2).take(at),
         pa.array([low[k] for k in rows], lists), pa.array([high[k] for k in rows], lists), pa.array(leaves, pa.binary())],
        ["grp", "query", "label", "vector", "low", "high", "leaves"])


def _compare(left: pa.Table, right: pa.Table, dims: int, count: int, same: bool, out: list[list]) -> None:
    names, first = right.column("class").to_numpy(), right.column("first_id").to_numpy()
    labels, leaf = right.column("label").to_numpy(), right.column("leaf").to_numpy()
    ids = right.column("ids").to_pylist()
    rows = _matrix(right.column("vector"), dims)
    held = np.unique(leaf)
    for lo in range(0, left.num_rows, ROWS):
        part = left.slice(lo, ROWS)
        asking = _matrix(part.column("vector"), dims)
        largest = np.abs(asking).max(initial=0) * np.abs(rows).max(initial=0) * max(dims, 1)
        # whole numbers below 2 ** 53 are exact in doubles
        scores = (asking @ rows.T if largest < 2.0 ** 53 else asking.astype(np.int64) @ rows.astype(np.int64).T).astype(np.int64)
        for k, (query, label, lows, highs, leaves) in enumerate(zip(*(
                part.column(c).to_pylist() for c in ("query", "label", "low", "high", "leaves")), strict=True)):
            score = scores[k]
            fits = (labels == label) if same else (labels != label)
            wanted = np.frombuffer(leaves, np.int32)
            if len(wanted) and not np.isin(held, wanted).all():
                fits &= np.isin(leaf, wanted)
            at = np.flatnonzero(fits & (score >= min(lows)) & (score <= max(highs)))
            at = at[np.lexsort((names[at], first[at], -score[at]))]
            ordered = -score[at]
            for w, (a, z) in enumerate(zip(lows, highs, strict=True)):
                begin, end = np.searchsorted(ordered, -z, "left"), np.searchsorted(ordered, -a, "right")
                found = at[begin:min(end, begin + count)]
                out[0] += [query] * len(found)
                out[1] += [w] * len(found)
                for values, column in ((score, 2), (names, 3), (first, 4)):
                    out[column] += values[found].tolist()
                out[5] += [np.frombuffer(ids[i], "<i8") for i in found.tolist()]


def usable_rows(table: DataFrame) -> DataFrame:
    """vec_id, label, vector: the rows that take part, labels and components as they count."""
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        whole_numbers(F.col("embedding")).alias("vector")).dropna().select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "vector")


def mine(run: Scratch, rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """The hard negatives of the rows that ``anchors`` marks.

    ``rows``: vec_id, label (long), vector (array of int, see :func:`whole_numbers`).  Returns
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each
    anchor and each of its first ``positives`` other rows of the same label, the first
    ``negatives`` rows of another label whose score is within ``low`` to ``high`` percent
    of the positive's; by score, largest first, ties by vec_id.

    Rows with a null in any of the three columns take no part, nor do vectors with a
    component beyond ``LARGEST`` once scaled (about 131,000).  Vectors of different lengths have
    no score with each other.  Rows that repeat all three columns count once; a row of
    the same vec_id but another vector is another row.  An empty table gives no rows.
    """
    rows = run.stage(rows.dropna().groupBy("vec_id", "label", "vector").agg(
        F.max(F.coalesce(anchors, F.lit(False))).alias("asks")), "rows")
    # equal vectors of one label are one class, of which no answer can use more than its first ids
    most = max(positives + 1, negatives)
    by_id = F.row_number().over(Window.partitionBy("label", "vector").orderBy("vec_id"))
    classes = run.stage(rows.withColumn("at", by_id).filter(F.col("at") <= most).groupBy("label", "vector").agg(
        F.min("vec_id").alias("first_id"), F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn(
        "class", F.monotonically_increasing_id()), "classes")
    asking = rows.filter("asks").groupBy("label", "vector").agg(F.count("*").alias("asked"))
    asking = run.stage(asking.join(classes.select("label", "vector", "class"), ["label", "vector"]), "asking")
    anchors_ = run.stage(lookup(rows.filter("asks").select("vec_id", "label", "vector"),
                                asking, ["label", "vector"], "asked").select("vec_id", "class"), "anchors")
    answers = None
    for length in classes.select(F.size("vector").alias("n")).distinct().toLocalIterator():
        of_length = F.size("vector") == length["n"]
        index = Index(run, classes.filter(of_length), length["n"])
        found = _answers(run, index, asking.filter(of_length), positives, negatives, low, high)
        answers = found if answers is None else answers.unionByName(found)
    if answers is None:
        return run.spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                             "positive_score long, negative_score long")
    answers = run.stage(answers, "answers")
    each = lookup(anchors_, answers, ["class"], "asked")
    others = F.slice(F.filter("positives", lambda p: (p["vec_id"] != F.col("vec_id")) | (p["class"] != F.col("class"))),
                     1, positives)
    each = each.select(F.col("vec_id").alias("anchor_id"), F.explode(others).alias("p"), "negatives")
    each = each.select("anchor_id", "p", F.explode(F.filter("negatives", lambda n: n["score"] == F.col("p.score"))).alias("n"))
    return each.select("anchor_id", "p", F.posexplode("n.first").alias("at", "n")).select(
        "anchor_id", F.col("p.vec_id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
        F.col("n.vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"))


def _first(found: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The first ``count`` rows, not classes, of each search as an array."""
    entry = F.col("entry")
    each = found.select(*keys, "score", "class", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "class")
    each = each.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= count)
    return each.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("place", "score", "vec_id", "class"))).alias("entry")) \
        .select(*keys, entry.alias("found"))


def _answers(run: Scratch, index: Index, asking: DataFrame, positives: int, negatives: int, low: int,
             high: int) -> DataFrame:
    """class, asked, positives and, for each of their scores, the negatives."""
    queries = run.stage(asking.select(F.col("class").alias("query"), "asked").join(
        index.vectors.select(F.col("class").alias("query"), "label", "vector", "grp"), "query"), "queries")
    one = queries.withColumn("scores", F.array(F.lit(0).cast("long")))
    same = run.stage(_first(index.search(one, positives + 1, True, name="positives"), ["query"], positives + 1), "positives")
    scores = F.array_distinct(F.transform("found", lambda p: p["score"]))
    with_scores = run.stage(queries.join(same, "query").withColumn("scores", scores), "scored")
    found = _first(index.search(with_scores.drop("found"), negatives, False, low, high, "negatives"),
                   ["query", "at"], negatives)
    other = with_scores.select("query", F.posexplode("scores").alias("at", "score")).join(found, ["query", "at"])
    other = other.groupBy("query").agg(F.collect_list(F.struct("score", F.col("found").alias("first"))).alias("negatives"))
    return with_scores.join(other, "query").select(F.col("query").alias("class"), "asked", F.col("found").alias("positives"),
                                                   "negatives")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every vector whose id is divisible by 100."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    with scratch(spark) as run:
        return run.result(mine(run, usable_rows(table), F.col("vec_id") % 100 == 0), "op13")


OP13_SQL = f"""
    WITH usable AS (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS vector
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    anchors AS (SELECT * FROM usable WHERE vec_id % 100 = 0),
    pairs AS (
        SELECT a.vec_id AS anchor_id, a.vector AS anchor, a.label = c.label AS same, c.vec_id,
               CAST(list_inner_product(a.vector, c.vector) AS BIGINT) AS score
        FROM anchors a JOIN usable c ON NOT (a.vec_id = c.vec_id AND a.vector = c.vector AND a.label = c.label)),
    positives AS (
        SELECT anchor_id, anchor, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor ORDER BY score DESC, vec_id) <= {POSITIVES}),
    ranked AS (
        SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.anchor, positive_id ORDER BY score DESC, vec_id) AS rank
        FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND n.anchor = p.anchor AND NOT same
             AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM ranked WHERE rank <= {NEGATIVES}"""
