"""Near-duplicate documents by circulant MinHash, confirmed on whole shingle sets.

Signatures.  One permutation spreads a document's shingles over 2**20 places; a
second one, shifted by one place per coordinate, gives all coordinates: the
coordinate k of a set is the least value of the second permutation at its
places moved by k.  So a signature is a minimum over contiguous windows of one
table, and no further hash is computed.

Candidates.  Documents with equal shingle sets form one class.  Signature bands
put classes into buckets; each class is confirmed against the smallest class of
its buckets, which takes one pair per class and bucket and joins nearly all of
a group.  The members of buckets that still hold different components are
compared by their rarest shingles: two sets that are similar enough share one of
those.  Every link rests on the intersection of whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.llm.components import components
from claimflow.llm.joins import lookup
from claimflow.llm.scratch import Scratch, scratch
from claimflow.llm.words import Words, mix, word_hashes

PLACES = 1 << 20
MISSED = 1.2e-5              # how often a pair just similar enough shares no band, at most
MOST = 160                   # coordinates of a signature, at most


def layout(percent: int) -> tuple[int, int]:
    """(bands, rows): as many rows as ``MOST`` allows at ``MISSED``.

    24 of 6 at 85 percent, 29 of 5 at 80.  Below 7 percent there is no such layout:
    then ``MOST`` bands of one row.
    """
    similar, best = min(percent, 99) / 100, (MOST, 1)
    for rows in range(1, MOST):
        bands = math.ceil(math.log(MISSED) / math.log1p(-similar ** rows)) if similar > 0 else MOST + 1
        if bands * rows <= MOST:
            best = (bands, rows)
    return best


BANDS, ROWS = layout(85)
COORDINATES = BANDS * ROWS
BLOCK = 512                  # sets behind one rare shingle that a probing row meets
PER_KEY = 1024               # pairs that meet one class's shingles in one task
LIKELY = 0.70                # 0.85 is seen below this once in a million times, of 144 coordinates

_RNG = np.random.Generator(np.random.PCG64(4099))
_SECOND = _RNG.permutation(PLACES).astype(np.uint32)
_TABLE = np.concatenate([_SECOND, _SECOND[:MOST]])
_FACTORS = _RNG.integers(1, 1 << 63, MOST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def _windows(coordinates: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(_TABLE, coordinates)


def shingles(words: Words, size: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a shorter text is one shingle, an empty one none."""
    h = words.hashes
    rolled = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        rolled = mix(rolled * np.uint64(3) + h[k:len(h) - size + 1 + k]) if len(rolled) else rolled
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(rolled[a:b - size + 1])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for x in h[a:b]:
                whole = mix(whole * np.uint64(5) + x)
            yield whole
        else:
            yield h[:0]


def signature(sets: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The circulant MinHash coordinates of a non-empty set."""
    windows = _windows(coordinates)
    at = (mix(sets ^ np.uint64(0x5DEECE66D)) >> np.uint64(44)).astype(np.int64)  # first permutation
    out = windows[at[:2048]].min(axis=0)
    for lo in range(2048, len(at), 2048):
        np.minimum(out, windows[at[lo:lo + 2048]].min(axis=0), out=out)
    return out


def bands(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Band keys, one for each ``rows`` coordinates, of signatures."""
    count = signatures.shape[1] // rows
    parts = mix(signatures.astype(np.uint64).reshape(len(signatures), count, rows) * _FACTORS[:rows])
    return mix(parts.sum(axis=2, dtype=np.uint64) + np.arange(count, dtype=np.uint64))


PRINT = "doc_id long, n long, s1 long, s2 long, bands array<long>, sketch binary"


def prints(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """One row per document: shingle count, two 64-bit sums that name its set, band
    keys, and the signature's low 16 bits."""
    count, rows = layout(percent)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in word_hashes(batch.column(1), lower=True):
                sets = list(shingles(words, size))
                counts = np.array([len(s) for s in sets], np.int64)
                sums = np.array([(s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)) for s in sets],
                                np.uint64).reshape(-1, 2).view(np.int64)
                full = np.flatnonzero(counts)
                signatures = np.zeros((len(sets), count * rows), np.uint32)
                for k in full:
                    signatures[k] = signature(sets[k], count * rows)
                keys = bands(signatures, rows).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, count, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(words.lo, words.hi - words.lo), pa.array(counts),
                    pa.array(sums[:, 0]), pa.array(sums[:, 1]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel())),
                    pa.array([x.tobytes() for x in signatures.astype("<u2")], pa.binary())],
                    ["doc_id", "n", "s1", "s2", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(make, PRINT)


def shingle_sets(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, shingles) of every non-empty document."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in word_hashes(batch.column(1), lower=True):
                sets = list(shingles(words, size))
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(words.lo, words.hi - words.lo),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))],
                    ["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        make, "doc_id long, shingles array<long>").filter("size(shingles) > 0")


def named_docs(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with one of the ids: one sort-merge join at every size, so that
    a run's needs grow with its input and not in steps."""
    return docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi")


def confirm(run: Scratch, docs: DataFrame, pairs: DataFrame, size: int, percent: int, tag: str) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole shingle sets are similar enough.

    A set that many pairs ask for is spread over copies, so that at most about
    ``PER_KEY`` pairs meet it in one place.
    """
    ids = run.stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(
        F.count("*").alias("pairs")), f"{tag}-ids")
    sets = run.stage(shingle_sets(named_docs(docs, ids.select("doc_id")), size).join(ids, "doc_id")
                     .select("doc_id", "shingles", F.ceil(F.col("pairs") / PER_KEY).cast("int").alias("copies")),
                     f"{tag}-sets")
    spread = sets.select("doc_id", "shingles", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    copies = sets.select("doc_id", "copies")

    def side(name: str, frame: DataFrame) -> DataFrame:
        many = frame.join(copies.filter("copies > 1").withColumnRenamed("doc_id", name).distinct(), name, "left")
        placed = many.withColumn("copy", F.pmod(F.xxhash64("a", "b"), F.coalesce("copies", F.lit(1))).cast("int"))
        return placed.drop("copies").join(spread.withColumnRenamed("doc_id", name), [name, "copy"]).drop("copy")

    one = side("a", pairs.select("a", "b")).withColumnRenamed("shingles", "x")
    two = side("b", one).withColumnRenamed("shingles", "y")
    both = F.size(F.array_intersect("x", "y"))
    return two.filter(both * 100 >= (F.size("x") + F.size("y") - both) * percent).select("a", "b").distinct()


def rare_shingles(run: Scratch, sets: DataFrame, percent: int) -> DataFrame:
    """(at, doc_id, root, n, s, place, short) of the shingles by which a set can meet others.

    ``sets`` has at (the set's number), doc_id, root, shingles.  All sets put their
    shingles in one order: first those that only one component holds, then the
    others, rarest first.  Two sets that are similar enough share a shingle of which
    the larger set has no more than ``n - ceil(t n) + 1`` up to it (the rows
    returned), and the smaller one no more than ``n - ceil(2 t n / (1 + t)) + 1``
    (``short``).  A shingle of one component has a place but can join nothing, so it
    is no row.
    """
    each = sets.select("at", "doc_id", "root", F.size("shingles").cast("long").alias("n"),
                       F.explode("shingles").alias("s"))
    shared = run.stage(each.groupBy("s").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("rows"))
        .filter("lo <> hi").select("s", "rows", F.col("rows").alias("holders")), "shared")
    held = lookup(each, shared, ["s"], "rows")
    own = Window.partitionBy("at")
    placed = held.withColumn("place", F.col("n") - F.count("*").over(own)
                             + F.row_number().over(own.orderBy("holders", "s")))
    return placed.filter(F.expr(f"place <= n - (n * {percent} + 99) div 100 + 1")).select(
        "at", "doc_id", "root", "n", "s", "place",
        F.expr(f"place <= n - (2 * n * {percent} + {99 + percent}) div {100 + percent} + 1").alias("short"))


def leftover_pairs(run: Scratch, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) ids of sets of different components that may be similar enough; none is missed.

    The smaller set of a pair is found by the larger one through a shared rare
    shingle.  The sets behind a shingle are dealt over parts of about ``BLOCK``, so a
    shingle that very many sets hold is no one task's work; its rows are numbers,
    not sets.
    """
    rare = run.stage(rare_shingles(run, sets, percent), "rare")
    met = run.stage(rare.groupBy("s").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("rows"),
        F.count_if("short").alias("held")).filter("lo <> hi AND held > 0").select(
        "s", "rows", F.ceil(F.col("held") / BLOCK).cast("int").alias("parts")), "met")
    active = run.stage(lookup(rare, met, ["s"], "rows"), "active")
    index = active.filter("short").withColumn("part", F.pmod(F.xxhash64("at"), F.col("parts")).cast("int")).alias("x")
    probe = active.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("y")
    # the first shingle that two sets share bounds what they can have in common after it
    return index.join(probe, F.expr(f"""
        x.s = y.s AND x.part = y.part AND x.root <> y.root
        AND (x.n < y.n OR (x.n = y.n AND x.at < y.at)) AND 100 * x.n >= {percent} * y.n
        AND ({100 + percent}) * (1 + least(x.n - x.place, y.n - y.place)) >= {percent} * (x.n + y.n)""")).select(
        F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()


def leftover_links(run: Scratch, docs: DataFrame, keys: DataFrame, roots: DataFrame, size: int,
                   percent: int) -> DataFrame:
    """Links (a, b) between members of mixed buckets that are still in different components.

    A bucket is mixed when its members are in several components.  Members of mixed
    buckets are compared whether or not they share one.
    """
    labelled = run.stage(keys.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "key", "class_id", F.coalesce("root", "class_id").alias("root")), "labelled")
    mixed = run.stage(
        labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"))
        .filter("lo <> hi").select("key", "n", F.lit(True).alias("mixed")), "mixed")
    members = run.stage(lookup(labelled, mixed, ["key"], "n").select(
        F.col("class_id").alias("doc_id"), "root").distinct(), "members")
    sets = run.stage(shingle_sets(named_docs(docs, members.select("doc_id")), size).join(members, "doc_id")
                     .withColumn("at", F.monotonically_increasing_id()), "member-sets")
    pairs = run.stage(leftover_pairs(run, sets, percent), "leftover-pairs")
    return confirm(run, docs, pairs, size, percent, "leftover")


def near_duplicates(run: Scratch, docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Texts are lower-cased (A-Z) and cut into words; a document's set is its
    distinct ``size``-word shingles, with fewer words the whole sequence as one.
    Documents are linked when ``100 * intersection >= percent * union``;
    ``component_id`` is the smallest doc_id that links reach.  Null and empty
    texts have no shingles and no links.  A row with a null doc_id takes no part
    and has a null component.  Rows that share a doc_id are one document: what any
    of them links to is linked.  Other columns are not read; an empty table gives
    no rows.
    """
    base = run.stage(prints(docs, size, percent), "prints")
    named = base.filter("n > 0 AND doc_id IS NOT NULL")
    classes = run.stage(named.groupBy("n", "s1", "s2").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("rows"), F.max("doc_id").alias("top")), "classes")
    lead = classes.select("n", "s1", "s2", "class_id", F.col("class_id").alias("doc_id"))
    of_class = ["class_id", "n", "s1", "s2"]
    reps = run.stage(named.join(lead, ["doc_id", "n", "s1", "s2"]).select(*of_class, "bands", "sketch"), "reps")
    if reps.count() > classes.count():      # rows repeat: one of them is enough from here on
        reps = run.stage(reps.dropDuplicates(of_class), "reps-once")
        docs = run.stage_texts(docs.select("doc_id", "text").dropDuplicates(), "docs-once")
    keys = reps.select("class_id", F.explode("bands").alias("key"))
    buckets = run.stage(
        keys.groupBy("key").agg(F.min("class_id").alias("a"), F.max("class_id").alias("top"),
                                F.count("*").alias("n")).filter("a <> top").select("key", "a", "n"), "buckets")
    keys = run.stage(keys.join(buckets.select("key"), "key", "left_semi"), "keys")
    stars = run.stage(lookup(keys, buckets, ["key"], "n").filter("a <> class_id").select(
        "a", F.col("class_id").alias("b")).distinct(), "stars")
    likely = reps.select("class_id", "sketch")
    links = run.stage(confirm(run, docs, _agreeing(run, stars, likely), size, percent, "star"), "links")
    roots = run.stage(components(run, links), "roots")

    more = run.stage(leftover_links(run, docs, keys, roots, size, percent), "more")
    if more.limit(1).count():
        roots = run.stage(components(run, links.unionByName(more)), "roots")

    rooted = classes.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "n", "s1", "s2", F.coalesce("root", "class_id").alias("component_id"), "rows")
    rooted = run.stage(rooted, "rooted")
    rows = base.select("doc_id", "n", "s1", "s2")
    out = lookup(rows.filter("n > 0 AND doc_id IS NOT NULL"), rooted, ["n", "s1", "s2"], "rows").unionByName(
        rows.filter("n = 0 OR doc_id IS NULL").withColumn("component_id", F.col("doc_id")))
    return _one_component_per_id(run, run.stage(out, "out")).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")


def _agreeing(run: Scratch, pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in at least ``LIKELY`` of the places."""
    one = pairs.join(sketches.select(F.col("class_id").alias("b"), F.col("sketch").alias("y")), "b")
    two = one.join(sketches.select(F.col("class_id").alias("a"), F.col("sketch").alias("x")), "a")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            x, y = (np.frombuffer(b"".join(c.to_pylist()), "<u2").reshape(len(batch), -1)
                    for c in (batch.column(2), batch.column(3)))
            yield batch.filter(pa.array((x == y).mean(axis=1) >= LIKELY)).select([0, 1])

    return run.stage(two.select("a", "b", "x", "y").mapInArrow(agree, "a long, b long").distinct(), "agreeing")


def _one_component_per_id(run: Scratch, rows: DataFrame) -> DataFrame:
    """Merge the components that rows sharing a doc_id fall into."""
    several = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("component_id").alias("lo"), F.max("component_id").alias("hi")).filter("lo <> hi")
    several = run.stage(several.select(F.col("lo").alias("a"), F.col("hi").alias("b")).unionByName(
        rows.join(several, "doc_id").select(F.col("component_id").alias("a"), F.col("lo").alias("b"))), "several")
    if not several.limit(1).count():
        return rows
    merged = components(run, several).withColumnRenamed("node", "component_id")
    return rows.join(run.stage(merged, "merged"), "component_id", "left").withColumn(
        "component_id", F.coalesce("root", "component_id"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its near copies."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark) as run:
        return run.result(near_duplicates(run, docs).withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "op10")


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies, all columns.

    Groups are linked on five-word shingles at a similarity of 0.8.
    """
    with scratch(spark) as run:
        found = near_duplicates(run, docs, size=5, percent=80)
        dropped = run.result(found.filter("doc_id <> component_id").select("doc_id").distinct(), "dropped")
    return docs.join(dropped.hint("merge"), "doc_id", "left_anti").select(*docs.columns)
