"""Stupid-backoff scores of documents under the counts of all other documents.

A word scores the count of the longest n-gram that ends with it and occurs in
another document, over the count of that n-gram without its last word; each
order given up costs a factor of 0.4.  A single word scores its share of the
corpus.  A document's own occurrences count nowhere in its score, so that a
word backs off where the rest of the corpus truly lacks the n-gram; no n-gram
is pruned.  Logarithms are whole millionths, so sums do not depend on their order.

The n-grams of all orders are exploded from slices of texts, reduced to one
entry per slice and n-gram, and shuffled to ranges of their hash.  A range sums
the entries to its part of the count table and joins the counts to the slices
that asked.  The slices are staged in buckets of their number, so that only the
counts are shuffled to meet the texts again, slice by slice, and no text is moved
twice; scores are summed per document.  N-grams that are more than 1/32,768 of all words (fewer than that in
each order, whatever the corpus) are counted beforehand, pre-summed in every
slice, and their counts are at hand everywhere: no range holds a hot n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.scratch import Scratch, scratch
from claimflow.llm.words import mix, word_hashes

BACKOFF = 0.4
ORDER = 3
COMMON = 1 << 15        # an n-gram is common when it is more than 1/COMMON of all words
SLICE_BYTES = 8 << 20   # texts that are counted together before the shuffle
RANGE_GRAMS = 2_000_000  # n-gram occurrences to a range of hashes
_ROW = 1 << 33          # slices of a task, in their numbers
LOSS = int(np.rint(np.log(BACKOFF) * 1e6))


def micro(counts: np.ndarray) -> np.ndarray:
    """Logarithms in whole millionths."""
    return np.rint(np.log(np.maximum(counts, 1).astype(np.float64)) * 1e6).astype(np.int64)


def codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest one needs, the highest bytes
    of all first, compressed; the first byte tells that width."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    bytes_ = numbers.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width:]
    return bytes([width]) + codec().compress(np.ascontiguousarray(bytes_.T).tobytes(), asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    width = data[0]
    bytes_ = np.zeros((n, 8), np.uint8)
    held = codec().decompress(data[1:], width * n, asbytes=True)
    bytes_[:, 8 - width:] = np.frombuffer(held, np.uint8).reshape(width, n).T
    return bytes_.view(">u8").ravel().astype(np.uint64)


def _pack_grams(names: np.ndarray) -> bytes:
    """Sorted hashes as their differences."""
    return _pack(np.diff(names, prepend=np.uint64(0)))


def _unpack_grams(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(data, n), dtype=np.uint64)


def _pack_texts(ids: pa.Array, texts: pa.Array) -> bytes:
    sink, batch = pa.BufferOutputStream(), pa.RecordBatch.from_arrays([ids, texts], ["ids", "texts"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=codec())) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack_texts(data: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(data.as_buffer()).read_next_batch()


SLICES = "base long, docs binary"


def slices(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in rows of about ``SLICE_BYTES`` of text; a longer text is alone."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() * _ROW
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            ends = np.cumsum([x or 0 for x in pa.compute.binary_length(texts).to_pylist()], dtype=np.int64)
            lo = 0
            while lo < len(ends):
                before = int(ends[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
                docs_ = _pack_texts(batch.column(0).slice(lo, hi - lo), texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([pa.array([base], pa.int64()), pa.array([docs_], pa.binary())],
                                                 ["base", "docs"])
                base, lo = base + 1, hi

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(cut, SLICES)


class Grams(NamedTuple):
    first: np.ndarray              # where each text's words begin, and the number of words
    doc: np.ndarray                # the text of each word
    place: np.ndarray              # its place there
    orders: list[np.ndarray]       # by order: the hash of the n-gram that ends with the word, 0 for none


def grams(texts: pa.Array, order: int) -> Grams:
    """The n-grams of a slice's texts."""
    hashes, first = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for words in word_hashes(texts):
        hashes.append(words.hashes)
        first.append(words.first[1:] + first[-1][-1])
    h, begins = np.concatenate(hashes), np.concatenate(first)
    doc = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    place = np.arange(len(h)) - begins[doc]
    orders = [h]
    for k in range(2, order + 1):
        longer = np.zeros(len(h), np.uint64)
        at = np.flatnonzero(place >= k - 1)
        longer[at] = mix(orders[-1][at - 1] * np.uint64(3) + h[at] + np.uint64(k))
        orders.append(longer)
    return Grams(begins, doc, place, orders)


def asked(found: Grams) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts) of a slice, by hash, of every order."""
    return np.unique(np.concatenate([g[found.place >= k] for k, g in enumerate(found.orders)]), return_counts=True)


def _texts(batch: pa.RecordBatch, row: int) -> pa.Array:
    return _unpack_texts(batch.column("docs")[row]).column("texts")


COUNTS = "total boolean, gram long, c long"


def _count_rows(total: bool, names: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total] * len(names), pa.bool_()), pa.array(names.view(np.int64)),
                                       pa.array(counts.astype(np.int64))], ["total", "gram", "c"])


def common_grams(run: Scratch, cut: DataFrame, order: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(n-grams, counts, words of the corpus) of the n-grams that are more than 1/COMMON
    of all words, by hash.

    A slice names its n-grams of more than half that share; an n-gram loses at most
    the other half by that, so all common ones are among those that are named for more
    than a half, of which there are at most ``2 * COMMON`` an order.  Those are counted.
    """
    shares = 2 * COMMON

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                found = grams(_texts(batch, row), order)
                names, counts = asked(found)
                much = counts > len(found.doc) // shares
                yield _count_rows(False, names[much], counts[much])
                yield _count_rows(True, np.zeros(1, np.uint64), np.array([len(found.doc)]))

    named = run.stage(cut.select("docs").mapInArrow(likely, COUNTS).groupBy("total", "gram").agg(
        F.sum("c").alias("c")), "named")
    total = named.filter("total").agg(F.max("c").alias("c")).first()["c"] or 0
    rows = named.filter(~F.col("total") & (F.col("c") > max(total // shares, 1))).select("gram").collect()
    candidates = np.sort(np.array([r["gram"] for r in rows], np.int64).view(np.uint64))
    if not len(candidates):
        return candidates, np.zeros(0, np.int64), total
    shared = run.spark.sparkContext.broadcast(candidates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for row in range(len(batch)):
                names, counts = asked(grams(_texts(batch, row), order))
                at = _found(names, shared.value)
                sums[at[at >= 0]] += counts[at >= 0]
        met = np.flatnonzero(sums)
        yield _count_rows(False, shared.value[met], sums[met])

    exact = cut.select("docs").mapInArrow(count, COUNTS).groupBy("gram").agg(F.sum("c").alias("c"))
    at = {r["gram"]: r["c"] for r in exact.filter(F.col("c") > max(total // COMMON, 1)).collect()}
    names = np.sort(np.array(list(at), np.int64).view(np.uint64))
    return names, np.array([at[x] for x in names.view(np.int64).tolist()], np.int64), total


def _found(names: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted ``table``, -1 for none."""
    if not len(table):
        return np.full(len(names), -1)
    at = np.minimum(np.searchsorted(table, names), len(table) - 1)
    return np.where(table[at] == names, at, -1)


def _ranges(names: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each hash; it does not fall where the hashes rise."""
    return ((names >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _spans(names: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """(range, its part of the sorted hashes) of the ranges that have any."""
    of = _ranges(names, ranges)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]]) if len(of) else np.zeros(1, int)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(of[lo]), slice(lo, hi)


ASKED = "part int, base long, n int, grams binary, times binary"
ANSWERS = "base long, part int, counts binary"


def explode_grams(cut: DataFrame, common: np.ndarray, ranges: int, order: int) -> DataFrame:
    """Per slice and range of hashes: the n-grams that are not common, and how often they occur there."""
    shared = cut.sparkSession.sparkContext.broadcast(common)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                names, counts = asked(grams(_texts(batch, row), order))
                rare = _found(names, shared.value) < 0
                names, counts = names[rare], counts[rare]
                parts = list(_spans(names, ranges))
                yield pa.RecordBatch.from_arrays([
                    pa.array([p for p, _ in parts], pa.int32()),
                    pa.array([batch.column("base")[row].as_py()] * len(parts), pa.int64()),
                    pa.array([s.stop - s.start for _, s in parts], pa.int32()),
                    pa.array([_pack_grams(names[s]) for _, s in parts], pa.binary()),
                    pa.array([_pack(counts[s]) for _, s in parts], pa.binary())],
                    ["part", "base", "n", "grams", "times"])

    return cut.mapInArrow(explode, ASKED)


def join_counts(exploded: DataFrame) -> DataFrame:
    """Each slice's n-grams of a range with their counts in the corpus, in the slice's order."""
    def join(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        names = [_unpack_grams(x, n) for x, n in zip(table.column("grams").to_pylist(), sizes, strict=True)]
        times = np.concatenate([_unpack(x, n) for x, n in zip(table.column("times").to_pylist(), sizes, strict=True)])
        held, at = np.unique(np.concatenate(names), return_inverse=True)
        del names
        counts = np.zeros(len(held), np.int64)
        np.add.at(counts, at, times.astype(np.int64))
        answers = np.split(counts[at], np.cumsum(sizes)[:-1])
        return pa.table({"base": table.column("base"), "part": table.column("part"),
                         "counts": pa.array([_pack(x) for x in answers], pa.binary())})

    return exploded.groupBy("part").applyInArrow(join, ANSWERS)


def _others(of: np.ndarray, counts: np.ndarray, doc: np.ndarray, inside: np.ndarray, docs: int) -> np.ndarray:
    """By word: how often the n-gram that ends with it occurs in other documents."""
    out = np.zeros(len(doc), np.int64)
    at = np.flatnonzero(inside)
    at = at[counts[of[at]] > 1]      # the others occur here and nowhere else
    _, which, own = np.unique(of[at] * max(docs, 1) + doc[at], return_inverse=True, return_counts=True)
    out[at] = counts[of[at]] - own[which]
    return out


SCORES = "doc_id long, words long, hits array<long>, score long"


def slice_scores(cut: DataFrame, answers: DataFrame, known: tuple[np.ndarray, np.ndarray, int], ranges: int,
                 order: int) -> DataFrame:
    """(doc_id, words, hits, score) of every text; ``hits``: the words scored by an n-gram of
    order 2, 3 and so on."""
    shared = cut.sparkSession.sparkContext.broadcast(known)

    def score_slice(ids: pa.Array, texts: pa.Array, parts: dict[int, bytes]) -> pa.RecordBatch:
        common, often, total = shared.value
        found = grams(texts, order)
        names, _ = asked(found)
        place = _found(names, common)
        counts = np.where(place >= 0, often[place] if len(often) else 0, 0)
        rare = np.flatnonzero(place < 0)
        for part, span in _spans(names[rare], ranges):
            counts[rare[span]] = _unpack(parts[part], span.stop - span.start)
        docs, words = len(texts), np.diff(found.first)
        score = np.zeros(len(found.doc), np.int64)
        hits = np.zeros((docs, order - 1), np.int64)
        most = np.minimum(found.place, order - 1)      # orders that a word can give up
        level = [_others(np.searchsorted(names, g), counts, found.doc, found.place >= k, docs)
                 for k, g in enumerate(found.orders)]
        todo = np.ones(len(score), bool)
        for k in range(order - 1, 0, -1):
            at = np.flatnonzero(todo & (level[k] > 0))
            score[at] = micro(level[k][at]) - micro(level[k - 1][at - 1]) + (most[at] - k) * LOSS
            hits[:, k - 1] = np.bincount(found.doc[at], minlength=docs)
            todo[at] = False
        at = np.flatnonzero(todo)
        score[at] = micro(level[0][at]) - micro(total - words[found.doc[at]]) + most[at] * LOSS
        sums = np.zeros(docs, np.int64)
        np.add.at(sums, found.doc, score)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(words, pa.int64()), pa.array(hits.tolist(), pa.list_(pa.int64())), pa.array(sums)],
            ["doc_id", "words", "hits", "score"])

    def join(texts: pa.Table, counted: pa.Table) -> pa.Table:
        parts = dict(zip(counted.column("part").to_pylist(), counted.column("counts").to_pylist(), strict=True))
        texts = texts.combine_chunks().to_batches()
        return pa.Table.from_batches([
            score_slice(*_unpack_texts(b.column("docs")[row]).columns, parts)
            for b in texts for row in range(len(b))], _SCORE_TYPES)

    return cut.groupBy("base").cogroup(answers.groupBy("base")).applyInArrow(join, SCORES)


_SCORE_TYPES = pa.schema([("doc_id", pa.int64()), ("words", pa.int64()), ("hits", pa.list_(pa.int64())),
                          ("score", pa.int64())])


def score_corpus(run: Scratch, docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, words, hits, score_micro) of every row of ``docs`` (doc_id, text).

    ``score_micro`` is the sum of the words' log scores in millionths, ``hits`` how
    many words an n-gram of order 2, 3, ... ``order`` scored.  A word that no other
    document has counts as seen once.  Words are maximal runs of other than ASCII
    white space, as written.  Every row is a document: a repeated row is another
    document with the same text.  Null and empty texts have no words and score 0; a null doc_id stays
    null.  Other columns are not read; an empty table gives no rows.
    """
    cut = run.stage_dealt(slices(docs), "slices", "base")   # the texts lie where their counts go
    known = common_grams(run, cut, order)
    least = int(run.spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-known[2] * order // RANGE_GRAMS))
    answers = join_counts(explode_grams(cut, known[0], ranges, order))
    return slice_scores(cut, answers, known, ranges, order).withColumnRenamed("score", "score_micro")


def op3_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's stupid-backoff score, of order 3, under the counts of all others."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark) as run:
        return run.result(score_corpus(run, docs).select(
            "doc_id", "words", F.element_at("hits", 1).alias("pair_hits"),
            F.element_at("hits", 2).alias("triple_hits"), "score_micro"), "op3")


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
p AS (
  SELECT doc_id, unnest(words) AS w3, unnest(list_prepend(NULL, words[1:len(words) - 1])) AS w2,
         unnest(list_prepend(NULL, list_prepend(NULL, words))[1:len(words)]) AS w1
  FROM w WHERE len(words) > 0),
o1 AS (SELECT doc_id, w3, count(*) AS own, sum(count(*)) OVER (PARTITION BY w3) - count(*) AS c
       FROM p GROUP BY doc_id, w3),
o2 AS (SELECT doc_id, w2, w3, sum(count(*)) OVER (PARTITION BY w2, w3) - count(*) AS c
       FROM p WHERE w2 IS NOT NULL GROUP BY doc_id, w2, w3),
o3 AS (SELECT doc_id, w1, w2, w3, sum(count(*)) OVER (PARTITION BY w1, w2, w3) - count(*) AS c
       FROM p WHERE w1 IS NOT NULL GROUP BY doc_id, w1, w2, w3),
n AS (SELECT sum(own) AS n FROM o1),
s AS (
  SELECT p.doc_id, coalesce(o3.c, 0) > 0 AS triple, coalesce(o3.c, 0) = 0 AND coalesce(o2.c, 0) > 0 AS pair,
         CASE WHEN o3.c > 0 THEN round(ln(o3.c) * 1e6) - round(ln(b2.c) * 1e6)
              WHEN o2.c > 0 THEN round(ln(o2.c) * 1e6) - round(ln(b1.c) * 1e6)
                   + CASE WHEN p.w1 IS NULL THEN 0 ELSE round(ln(0.4) * 1e6) END
              ELSE round(ln(greatest(o1.c, 1)) * 1e6) - round(ln(greatest(n.n - len(w.words), 1)) * 1e6)
                   + round(ln(0.4) * 1e6) * ((p.w1 IS NOT NULL)::INT + (p.w2 IS NOT NULL)::INT) END AS score
  FROM p JOIN w ON w.doc_id = p.doc_id
  JOIN o1 ON o1.doc_id = p.doc_id AND o1.w3 = p.w3
  LEFT JOIN o2 ON o2.doc_id = p.doc_id AND o2.w2 = p.w2 AND o2.w3 = p.w3
  LEFT JOIN o3 ON o3.doc_id = p.doc_id AND o3.w1 = p.w1 AND o3.w2 = p.w2 AND o3.w3 = p.w3
  LEFT JOIN o2 b2 ON b2.doc_id = p.doc_id AND b2.w2 = p.w1 AND b2.w3 = p.w2
  LEFT JOIN o1 b1 ON b1.doc_id = p.doc_id AND b1.w3 = p.w2
  CROSS JOIN n),
t AS (SELECT doc_id, count(*) FILTER (pair) AS pair_hits, count(*) FILTER (triple) AS triple_hits,
             sum(score) AS score FROM s GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS words, coalesce(pair_hits, 0) AS pair_hits,
       coalesce(triple_hits, 0) AS triple_hits, CAST(coalesce(score, 0) AS BIGINT) AS score_micro
FROM w LEFT JOIN t USING (doc_id)
"""
