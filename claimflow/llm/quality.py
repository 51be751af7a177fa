"""Quality classifier: naive Bayes support vectors over byte n-grams.

A text's features are the byte 1-, 2- and 3-grams that occur in it, hashed to
2**18 numbers.  Each indicator is scaled by the log ratio of its frequency among
good and bad texts; a linear hinge-loss model over the scaled indicators is
fitted by dual coordinate descent, and its margins become probabilities by a
sigmoid fitted on labelled texts that the model has not seen.  Fitting takes a
bounded sample; scoring covers every whole text where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.scratch import Scratch, scratch
from claimflow.llm.words import mix, text_bytes

FEATURES = 1 << 18
SAMPLE = 12_000     # labelled texts that are fitted at most
COST, EPOCHS, SMOOTHING = 0.1, 10, 1.0
ACCEPT = 0.3        # texts with at least this score are predicted 1
PIECE = 1 << 20


class Model(NamedTuple):
    weights: np.ndarray   # per feature, ratio included
    bias: float
    slope: float          # of the sigmoid over margins
    offset: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        margins = np.array([self.weights[x].sum() + self.bias for x in features(texts)], np.float64)
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct feature numbers of each text; null and empty texts have none."""
    data, offsets = text_bytes(texts)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        grams = np.zeros(0, np.uint32)
        for lo in range(a, b, PIECE):  # a trigram begins in every piece exactly once
            x = data[lo:min(b, lo + PIECE + 2)].astype(np.uint32)
            x = np.concatenate([x, np.zeros(max(0, lo + PIECE + 2 - b), np.uint32)])[:min(PIECE, b - lo) + 2]
            three = np.unique((x[:-2] << 16) | (x[1:-1] << 8) | x[2:])
            grams = three if not len(grams) else np.union1d(grams, three)
        # 0 bytes stand beyond the end; prefixes of the distinct trigrams are the shorter n-grams
        two, one = np.unique(grams >> 8), np.unique(grams >> 16)
        codes = np.concatenate([grams | np.uint32(3 << 24), two | np.uint32(2 << 24), one | np.uint32(1 << 24)])
        yield np.unique((mix(codes.astype(np.uint64)) % np.uint64(FEATURES)).astype(np.uint32))


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> Model:
    """Fit on feature lists with labels 0/1; every fifth row only sets the sigmoid.

    Without rows the score is 0.5; with one class alone it is that class's.
    """
    if len(set(labels.tolist())) < 2:
        sure = 0.0 if not len(labels) else 40.0 * (2 * int(labels[0]) - 1)
        return Model(np.zeros(FEATURES), 0.0, 0.0, sure)
    order = np.random.default_rng(seed).permutation(len(rows))
    asked, learnt = order[::5], np.setdiff1d(order, order[::5])
    if len(set(labels[learnt].tolist())) < 2 or len(set(labels[asked].tolist())) < 2:
        asked = learnt = order
    sign = np.where(labels > 0, 1.0, -1.0)
    good, bad = np.full(FEATURES, SMOOTHING), np.full(FEATURES, SMOOTHING)
    for k in learnt:
        (good if sign[k] > 0 else bad)[rows[k]] += 1
    ratio = np.log(good / good.sum()) - np.log(bad / bad.sum())
    weights, bias = coordinate_descent([rows[k] for k in learnt], sign[learnt], ratio, seed)
    margins = np.array([weights[rows[k]].sum() + bias for k in asked])
    return Model(weights, bias, *sigmoid(margins, labels[asked] > 0))


def coordinate_descent(rows: list[np.ndarray], sign: np.ndarray, ratio: np.ndarray,
                       seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; weights with the ratio folded in.

    A row's ratios are looked up when it is its turn: kept, they are twice the rows' size.
    """
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    norms = np.array([ratio[x] @ ratio[x] + 1 for x in rows])
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            values = ratio[rows[k]]
            slack = sign[k] * (w[rows[k]] @ values + bias) - 1
            new = min(max(alpha[k] - slack / norms[k], 0.0), COST)
            if new != alpha[k]:
                step = (new - alpha[k]) * sign[k]
                alpha[k] = new
                w[rows[k]] += step * values
                bias += step
    return w * ratio, bias


def sigmoid(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of ``good`` given a margin (Newton steps)."""
    n = good.sum()
    goal = np.where(good, (n + 1) / (n + 2), 1 / (len(good) - n + 2))
    x = np.stack([margins, np.ones_like(margins)])
    scale = max(float(np.abs(margins).mean()), 1e-9)
    x[0] /= scale
    ab = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(ab @ x, -500, 500)))
        gradient = x @ (p - goal)
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), gradient)
        size = float(np.abs(step).max())
        ab -= step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return float(ab[0] / scale), float(ab[1])


def listed_features(column: pa.Array) -> list[np.ndarray]:
    """The feature lists of a binary column: pieces of one array, whose memory goes back when it
    is done with.  What thousands of small objects leave behind stays with a Python worker."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]
    return np.split(data.copy().view(np.uint32), (ends[1:-1] - ends[0]) // 4)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(run: Scratch, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents that are not held out.

    The ``sample`` smallest hashes of the ids are taken, so the choice does not
    depend on row order.  Null labels and ids, and ids with both labels, are left
    out; of rows with one id the smallest text counts.  The fit runs in one task
    on at most ``sample`` feature lists of at most 2**18 numbers each.
    """
    known = (labels.select("doc_id", "quality").dropna().filter("quality IN (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
             .filter(F.col("quality") == F.col("other")).filter(~held_out(F.col("doc_id"))))
    chosen = (run.stage(docs.select("doc_id").join(known, "doc_id").select("doc_id", "quality").distinct(), "known")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `sample` rows
             .groupBy("doc_id", "quality").agg(F.min("text").alias("text")))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x.tobytes() for x in features(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.binary())],
                                             ["doc_id", "quality", "features"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((i, int(q), f) for b in filter(len, batches) for i, q, f in
                       zip(b.column(0).to_pylist(), b.column(1).to_pylist(), listed_features(b.column(2)),
                           strict=True)), key=lambda r: r[0])
        model = fit([f for _, _, f in rows], np.array([q for _, q, _ in rows], int))
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()], pa.binary()), *(pa.array([x], pa.float64()) for x in model[1:])],
            ["weights", "bias", "slope", "offset"])

    kind = labels.select("quality").schema[0].dataType.simpleString()
    known_id = docs.select("doc_id").schema[0].dataType.simpleString()
    listed = run.stage(texts.mapInArrow(extract, f"doc_id {known_id}, quality {kind}, features binary"), "features")
    row = listed.repartition(1).mapInArrow(learn, "weights binary, bias double, slope double, offset double").first()
    return Model(np.frombuffer(row["weights"]), row["bias"], row["slope"], row["offset"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; a null or empty text is scored by the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, whatever the input

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared.value.scores(batch.column(1)), pa.float64())], ["doc_id", "score"])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score_batches, f"doc_id {kind}, score double")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score from its text alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark) as run:
        model = train(run, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the classifier accepts, all columns."""
    with scratch(spark) as run:
        model = train(run, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.scores(batch.column(at)) >= ACCEPT))

    return docs.mapInArrow(accept, docs.schema)
