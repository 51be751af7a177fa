"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words, so each of its documents an expected
number of copies: the same whole part for all, and a fractional part that is
rounded.  Rounding pairs two fractional units and moves word mass from one
to the other, at random but fair, until one of them has a whole number of
copies; the words of the pair together do not change.

A source's largest documents come first, one after the other: each is paired with
all smaller ones together, which share one probability and have words enough to make
up for it, so that it is the large one that becomes whole.  The others pair in small
blocks; the one fractional document that a block leaves over goes up a
reduction tree of blocks, until one per source is left, which is rounded alone.
So far each copy number has the expected value asked for, and only what was rounded
alone is missed.  This residual is made good among the largest documents: at most two
of them, twice, change their decision, those that bring the source nearest to its
target.  DataFrame functions only.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.llm.joins import lookup, unit_interval
from claimflow.llm.scratch import Scratch, scratch

BLOCK = 24        # mean number of fractional documents rounded together
LARGEST = 128     # documents of a source that are settled against all smaller ones together
REPAIRS = 2       # times that up to two of those change their decision
NEAR = 1e-9       # probabilities this near to 0 or 1 count as whole
UNIT = T.StructType([T.StructField("key", T.LongType()), T.StructField("size", T.DoubleType()),
                     T.StructField("p", T.DoubleType())])
DONE = T.StructType([T.StructField("key", T.LongType()), T.StructField("up", T.BooleanType())])
SETTLED = T.StructType([T.StructField("key", T.LongType()), T.StructField("size", T.DoubleType()),
                        T.StructField("up", T.BooleanType())])


def word_count(text: Column) -> Column:
    """Number of maximal runs of ``[^\\x20\\x09-\\x0D]``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(run: Scratch, sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2),
                   share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """(source, size) rows -> one row per source with its target size.

    Sources in code point order, null last, get ``weights`` in turn and share
    ``share`` (a fraction) of all sizes by weight.  A target stops at ``most``
    times its source's size; the excess is shared again by weight among the
    rest, until none is above: a level ``x`` with targets
    ``min(most * size, weight * x)``, found by raising it while sources stop.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    order = F.row_number().over(_by_source())
    turn = F.array(*[F.lit(w) for w in weights])
    per = run.stage(per.withColumn("weight", F.get(turn, ((order - 1) % len(weights)).cast("int"))), "sources")
    cap = F.col("source_size") * most
    total = per.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    goal = min(total * share[0] / share[1], float(total * most))
    level, stopped = 0.0, -1
    while True:
        row = per.agg(F.count(F.when(cap <= F.col("weight") * level, 1)).alias("stopped"),
                      F.sum(F.when(cap <= F.col("weight") * level, cap).otherwise(0)).alias("held"),
                      F.sum(F.when(cap <= F.col("weight") * level, 0).otherwise(F.col("weight"))).alias("rest")
                      ).first()
        if row["stopped"] == stopped or not row["rest"]:
            break
        stopped, level = row["stopped"], (goal - row["held"]) / row["rest"]
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(level)))
    return per.select("source", "source_size", "docs", target.alias("target"))


def _by_source():
    # one row per source, not per document, goes through this ordering
    return Window.orderBy(F.col("source").asc_nulls_last())


def _pivot(state: Column, unit: Column, seed: int) -> Column:
    """One pairing step of a block's fold: ``state`` (carry, done) meets ``unit``."""
    a, b = state["carry"], unit
    mass = a["size"] * a["p"] + b["size"] * b["p"]       # expected words of the pair
    # the pair's words are kept, so a's probability fixes b's; a's range:
    low = F.greatest(F.lit(0.0), (mass - b["size"]) / a["size"])
    high = F.least(F.lit(1.0), mass / a["size"])
    up = unit_interval(a["key"], b["key"], F.lit(seed)) * (high - low) < a["p"] - low
    return F.struct(a["key"].alias("ak"), a["size"].alias("as"), b["key"].alias("bk"),
                    b["size"].alias("bs"), mass.alias("mass"), F.when(up, high).otherwise(low).alias("ap"))


def _settled(state: Column, moved: Column) -> Column:
    """The state after a pairing step: whole documents are done, another is carried."""
    ap = moved["ap"]
    bp = (moved["mass"] - moved["as"] * ap) / moved["bs"]
    a_whole = (ap <= NEAR) | (ap >= 1 - NEAR)
    b_whole = (bp <= NEAR) | (bp >= 1 - NEAR)
    none = F.lit(None).cast(UNIT)

    def done(key: Column, p: Column) -> Column:
        return F.array(F.struct(key.alias("key"), (p > 0.5).alias("up")))

    def carry(key: Column, size: Column, p: Column) -> Column:
        return F.struct(key.alias("key"), size.alias("size"), p.alias("p"))

    empty = F.array().cast(T.ArrayType(DONE))
    return F.struct(
        F.when(a_whole & b_whole, none)
        .when(a_whole, carry(moved["bk"], moved["bs"], bp))
        .otherwise(carry(moved["ak"], moved["as"], ap)).cast(UNIT).alias("carry"),
        F.concat(state["done"], F.when(a_whole, done(moved["ak"], ap)).otherwise(empty),
                 F.when(b_whole | ~a_whole, done(moved["bk"], bp)).otherwise(empty)
                 ).cast(T.ArrayType(DONE)).alias("done"))


def round_blocks(units: DataFrame, blocks: Column, seed: int) -> DataFrame:
    """Round the units of each (source, block): (source_key, carry, done).

    ``units``: source_key, key, size (double, > 0), p (0 < p < 1).  A block's
    members are hashed to it, so it holds ``BLOCK`` units or a few times that;
    they are folded in the order of their key's hash.
    """
    placed = units.withColumn("block", F.pmod(F.xxhash64("key", F.lit(seed)), blocks))
    grouped = placed.groupBy("source_key", "block").agg(F.sort_array(F.collect_list(F.struct(
        F.xxhash64("key", F.lit(seed + 1)).alias("by"), "key", "size", "p"))).alias("units"))
    start = F.struct(F.lit(None).cast(UNIT).alias("carry"), F.array().cast(T.ArrayType(DONE)).alias("done"))

    def step(state: Column, u: Column) -> Column:
        unit = F.struct(u["key"].alias("key"), u["size"].alias("size"), u["p"].alias("p"))
        # transform over a one-element array names the moved pair once
        return F.when(state["carry"].isNull(), F.struct(unit.alias("carry"), state["done"].alias("done"))) \
            .otherwise(F.get(F.transform(F.array(_pivot(state, unit, seed)),
                                         lambda m: _settled(state, m)), 0))

    return grouped.select("source_key", F.aggregate("units", start, step).alias("s")).select(
        "source_key", F.col("s.carry").alias("carry"), F.col("s.done").alias("done"))


def settle_largest(units: DataFrame, seed: int, count: int = LARGEST) -> DataFrame:
    """The ``count`` largest units of each source, settled one after the other.

    ``units``: source_key, key, size (double, > 0), p (the same for a source's units).  Returns per
    source: settled (key, size, up), residual (the words by which a unit rounded alone, since all
    smaller ones are whole, missed its share), rest (the probability that the smaller units
    now share), and the last settled unit's size and key, behind which they come.
    """
    order = Window.partitionBy("source_key").orderBy(F.desc("size"), "key")
    top = units.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= count)
    top = top.groupBy("source_key").agg(F.sort_array(F.collect_list(F.struct("place", "key", "size"))).alias("top"))
    sums = units.groupBy("source_key").agg(F.sum("size").alias("words"), F.max("p").alias("p"))
    start = F.struct(F.col("words").alias("words"), (F.col("words") * F.col("p")).alias("mass"),
                     F.lit(0.0).alias("residual"), F.array().cast(T.ArrayType(SETTLED)).alias("settled"))

    def step(s: Column, u: Column) -> Column:
        # all smaller units are one partner with ``rest`` words
        rest = F.greatest(s["words"] - u["size"], F.lit(0.0))
        low = F.greatest(F.lit(0.0), (s["mass"] - rest) / u["size"])
        high = F.least(F.lit(1.0), s["mass"] / u["size"])
        p = F.greatest(low, F.least(high, s["mass"] / s["words"]))
        up = unit_interval(u["key"], F.lit(seed)) * (high - low) < p - low
        x = F.when(up, high).otherwise(low)

        def settled(x: Column) -> Column:
            # a fraction is left only where all smaller units are whole: it is rounded alone
            up = unit_interval(u["key"], F.lit(seed + 1)) < F.when(x <= NEAR, 0.0).when(x >= 1 - NEAR, 1.0).otherwise(x)
            unit = F.struct(u["key"].alias("key"), u["size"].alias("size"), up.alias("up"))
            return F.struct(
                rest.alias("words"), F.greatest(F.lit(0.0), F.least(rest, s["mass"] - x * u["size"])).alias("mass"),
                (s["residual"] + (x - up.cast("int")) * u["size"]).alias("residual"),
                F.concat(s["settled"], F.array(unit)).cast(T.ArrayType(SETTLED)).alias("settled"))

        return F.get(F.transform(F.array(x), settled), 0)

    last = F.element_at("top", -1)
    folded = top.join(sums, "source_key").select(
        "source_key", last["size"].alias("last_size"), last["key"].alias("last_key"), F.aggregate("top", start, step).alias("s"))
    return folded.select("source_key", "last_size", "last_key", F.col("s.settled").alias("settled"), F.col("s.residual").alias("residual"),
                         F.when(F.col("s.words") > 0, F.col("s.mass") / F.col("s.words")).otherwise(0.0).alias("rest"))


def repaired(settled: Column, residual: Column) -> Column:
    """The settled units after up to two changed decisions that make good most of the residual,
    as (settled, residual); of equal choices the one with the smaller keys."""
    change = lambda u: F.struct(F.when(u["up"], -u["size"]).otherwise(u["size"]).alias("words"), u["key"].alias("key"))
    none = F.struct(F.lit(0.0).alias("words"), F.lit(None).cast("long").alias("key"))

    def choices(changes: Column) -> Column:
        one = lambda x, y: F.struct(F.abs(residual - x["words"] - y["words"]).alias("off"),
                                    x["key"].alias("a"), y["key"].alias("b"), (residual - x["words"] - y["words"]).alias("residual"))
        pairs = F.transform(changes, lambda x, k: F.transform(
            F.slice(changes, k + 2, F.greatest(F.size(changes) - k - 1, F.lit(0))), lambda y: one(x, y)))
        return F.array_min(F.concat(F.array(one(none, none)), F.flatten(pairs)))

    def changed(best: Column) -> Column:
        turn = lambda u: u["key"].eqNullSafe(best["a"]) | u["key"].eqNullSafe(best["b"])
        return F.struct(F.transform(settled, lambda u: F.struct(
            u["key"].alias("key"), u["size"].alias("size"), (u["up"] != turn(u)).alias("up"))).alias("settled"),
            best["residual"].alias("residual"))

    changes = F.concat(F.array(none), F.transform(settled, change))
    return F.get(F.transform(F.array(F.get(F.transform(F.array(changes), choices), 0)), changed), 0)


def mix(run: Scratch, docs: DataFrame, seed: int = 11, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often each document is taken into the mix.

    Returns one row per row of ``docs``: ``doc_id``, ``source``, ``size`` (words),
    ``source_size``, ``target`` (of the source), ``copies``.  Copies are 0, 1 or
    2; the words taken of a source come as near its target as changing two of its
    largest documents' decisions, twice, can bring them.

    Null text has no words; documents without words and sources without words
    are taken 0 times.  A null source is a source of its own, the last.  Rows
    that repeat id, source and size are rounded as one and have the same copies;
    a null id is an id.  Other columns are not read.  The result depends on the
    rows alone, not on their order or partitions.
    """
    sizes = run.stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                  word_count(F.col(text_col)).alias("size")), "sizes")
    sizes = sizes.withColumn("source_key", F.xxhash64("source", F.col("source").isNull()))
    targets = run.stage(source_targets(run, sizes).withColumn(
        "source_key", F.xxhash64("source", F.col("source").isNull())), "targets")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets.select("source_key", "source_size", "target", "docs", F.col("docs").alias("n"),
                          F.floor(share + NEAR).cast("int").alias("whole"),
                          F.greatest(share - F.floor(share + NEAR), F.lit(0.0)).alias("p"))
    rows = lookup(sizes, plan, ["source_key"], "n").withColumn(
        "key", F.xxhash64("doc_id", F.col("doc_id").isNull(), "source_key", "size"))
    rows = run.stage(rows, "rows")

    units = rows.filter((F.col("p") > NEAR) & (F.col("size") > 0)).groupBy("source_key", "key").agg(
        F.sum("size").cast("double").alias("size"), F.first("p").alias("p"), F.first("docs").alias("docs"))
    units = run.stage(units, "units")
    settled = run.stage(settle_largest(units, seed - 1), "settled")
    rest = settled.select("source_key", "last_size", "last_key", "rest").join(
        units.groupBy("source_key").agg(F.count("*").alias("n")), "source_key")
    behind = (F.col("size") < F.col("last_size")) | ((F.col("size") == F.col("last_size")) & (F.col("key") > F.col("last_key")))
    units = run.stage(lookup(units.drop("p"), run.stage(rest, "rest"), ["source_key"], "n").filter(behind)
                      .withColumnRenamed("rest", "p").drop("last_size", "last_key"), "smaller")
    whole = units.filter(F.col("p") >= 1 - NEAR).select("key", F.lit(True).alias("up"))
    units = units.filter((F.col("p") > NEAR) & (F.col("p") < 1 - NEAR))
    largest = targets.agg(F.max("docs").alias("n")).first()["n"] or 0
    decided, shrink, level = [whole], 1, 0
    while True:
        shrink *= BLOCK
        blocks = F.greatest(F.ceil(F.col("docs") / shrink), F.lit(1)).cast("long")
        at = run.stage(round_blocks(units.select("source_key", "key", "size", "p",
                                                 blocks.alias("blocks")).withColumnRenamed("blocks", "b"),
                                    F.col("b"), seed + 2 * level), f"level{level}")
        decided.append(at.select("source_key", F.explode("done").alias("d")).select("d.key", "d.up"))
        left = at.filter("carry IS NOT NULL").select("source_key", "carry.*")
        if ceil(largest / shrink) <= 1:
            break
        level += 1
        counts = targets.select("source_key", "docs", F.col("docs").alias("n"))
        units = lookup(left, counts, ["source_key"], "n")
    left = left.withColumn("up", unit_interval("key", F.lit(seed)) < F.col("p"))
    decided.append(left.select("key", "up"))
    missed = left.select("source_key", ((F.col("p") - F.col("up").cast("int")) * F.col("size")).alias("missed"))
    largest = settled.join(missed, "source_key", "left").select("settled", (
        F.col("residual") + F.coalesce("missed", F.lit(0.0))).alias("residual"))
    largest = run.stage(largest, "missed")
    for k in range(REPAIRS):  # staged each time: inlined into the next one, a repair would run for each of its choices
        largest = run.stage(largest.select(repaired(F.col("settled"), F.col("residual")).alias("r")), f"repair{k}").select("r.*")
    decided.append(largest.select(F.explode("settled").alias("d")).select("d.key", "d.up"))
    ups = decided[0]
    for more in decided[1:]:
        ups = ups.unionByName(more)
    ups = ups.filter("up").select("key", F.lit(1).alias("extra"))
    return rows.join(ups, "key", "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("whole") + F.coalesce("extra", F.lit(0))).otherwise(0).alias("copies"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark) as run:
        out = mix(run, docs).select("doc_id", "size", "source_size", "target",
                                    (F.col("copies") * F.col("size")).cast("long").alias("taken"))
        return run.result(out, "op1")


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as many times as the mix takes it."""
    with scratch(spark) as run:
        copies = run.result(
            mix(run, docs).select("doc_id", "source", "size", "copies").filter("copies > 0").distinct(), "copies")
    # positions stand in for the documents' names, so that none of them can clash
    doc_id, text, source = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text", "source"))
    rows = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    columns = rows.columns
    rows = rows.withColumn("words", word_count(F.col(text)))
    joined = rows.join(copies.hint("merge"), rows[doc_id].eqNullSafe(copies["doc_id"]) & rows[source].eqNullSafe(copies["source"])
                       & (rows["words"] == copies["size"]))
    return joined.select(*columns, F.explode(F.sequence(F.lit(1), "copies"))).select(*columns).toDF(*docs.columns)
