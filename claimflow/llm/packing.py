"""Packing documents into fixed-length sequences, shortest pack first.

Texts are tokenised and cut into pieces of at most a sequence.  Only the
histogram of piece lengths (at most 2048 numbers) goes to the driver, where
lengths are placed longest first, each onto the shortest pack that has room;
packs of equal content are one pattern with a count, so that the work depends
on the sequence length, not on the number of documents.  The k-th piece of a
length then takes the k-th place that the patterns have for it: pieces are
ranked by task and joined with the patterns.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.llm.scratch import Scratch, scratch
from claimflow.llm.tokens import encoded, shared_encoder

LENGTH = 2048
END_ID = 1

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, place long"
_PIECE_TYPES = pa.schema([(c.split()[0], pa.int32() if c.endswith(" int") else pa.int64())
                          for c in PIECES.split(", ")])


def pieces(docs: DataFrame, length: int = LENGTH, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Every document's ids and the end id, cut into pieces of at most ``length``.

    ``task`` and ``place`` number the pieces of one length: ``place`` counts
    them within the task that made them.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = shared_encoder(path), TaskContext.get().partitionId()
        seen = [0] * (length + 1)
        for batch in batches:
            names, rows = batch.column(0).to_pylist(), []
            for k, ids in encoded(encoder, batch.column(1)):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), length):
                    part = ids[start:start + length]
                    rows.append((names[k], start, len(part), zlib.crc32(part), len(ids), task, seen[len(part)]))
                    seen[len(part)] += 1
                if len(rows) >= 50_000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        cut, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_PIECE_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECE_TYPES.types, strict=True)],
                                      schema=_PIECE_TYPES)


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, list[tuple[int, int]]]]:
    """Shortest-pack-first over a histogram of lengths.

    Returns (number of packs, [(piece length, how many)]).  Lengths go longest
    first; each piece goes onto the pack with the most room if it fits there,
    and opens a pack if not.  Packs that are alike are handled together.
    """
    open_packs: list[tuple[int, int, int, list[tuple[int, int]]]] = []   # (-room, order, packs, content)
    order = 0

    def push(room: int, packs: int, content: list[tuple[int, int]]) -> None:
        nonlocal order
        if packs:
            heapq.heappush(open_packs, (-room, order, packs, content))
            order += 1

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            if open_packs and -open_packs[0][0] >= size:
                room, _, packs, content = heapq.heappop(open_packs)
                used = min(packs, left)
                push(-room, packs - used, content)
                push(-room - size, used, _added(content, size, 1))
                left -= used
            else:
                each = length // size
                push(length - each * size, left // each, [(size, each)])
                rest = left % each
                if rest:
                    push(length - rest * size, 1, [(size, rest)])
                left = 0
    return [(packs, content) for _, _, packs, content in sorted(open_packs)]


def _added(content: list[tuple[int, int]], size: int, n: int) -> list[tuple[int, int]]:
    if content and content[-1][0] == size:
        return [*content[:-1], (size, content[-1][1] + n)]
    return [*content, (size, n)]


def places(packed: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int]]:
    """Patterns as (length, first rank, end rank, first sequence, offset) rows."""
    rows, taken, sequence = [], {}, 0
    for packs, content in packed:
        offset = 0
        for size, n in content:
            for _ in range(n):
                first = taken.get(size, 0)
                rows.append((size, first, first + packs, sequence, offset))
                taken[size] = first + packs
                offset += size
        sequence += packs
    return rows


def pack(run: Scratch, docs: DataFrame, length: int = LENGTH, path: str | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents: one row per piece.

    ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``.  Documents longer than a sequence fill whole
    sequences with their first pieces.  Null and empty texts are the end id
    alone; repeated rows are packed once each; a null id stays null; an empty
    table gives no pieces.  Other columns are not read.
    """
    cut = run.stage(pieces(docs, length, path, id_col, text_col), "pieces")
    counts = run.stage(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    # at most one number per length and task is ordered within a length
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `length` rows
    table = run.spark.createDataFrame(
        places(patterns(histogram, length)),
        "at long, first long, until long, sequence long, offset long")
    # the pattern table is bounded by the sequence length, whatever the number of documents
    ranked = cut.join(bases, ["task", "length"]).withColumn("rank", F.col("base") + F.col("place"))
    return ranked.join(F.broadcast(table), (F.col("length") == F.col("at")) & (F.col("rank") >= F.col("first"))
                       & (F.col("rank") < F.col("until"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")


def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark) as run:
        return run.result(pack(run, docs), "op9")


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents in their sequences."""
    with scratch(spark) as run:
        return run.result(pack(run, docs), "packed")
