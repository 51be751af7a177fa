"""Sorted digest arrays: files of 64-bit keys that tasks memory-map and search.

An array holds distinct strings, each with a few bytes of payload, sorted by the
xxhash of the string.  Spark builds it from a table: the keys are dealt by their
highest bits, one task packs each part, and Spark's text writer puts the parts
into the shared folder (a part is one "line" of raw bytes, a file of its own).
Executors fetch the files from there as files of the application, a lost
executor's replacement as well, and every Python worker maps them: pages of a file
are read when a probe touches them and are shared by the workers of a machine, so
an array may be larger than a worker's memory, and no task or driver holds it.

The files stay in the shared folder until the cluster clears it: an executor
that starts later in the application fetches them again.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.session import scratch_path

SEED = 42                 # of Spark's xxhash64
PART_BYTES = 32 << 20     # of one file, about
HEADER = 8


def digest(data: bytes, bits: int = 64) -> int:
    """The key of a string, as the Spark function has it."""
    return xxhash.xxh64_intdigest(data, SEED) >> (64 - bits)


def text_key(text: Column, bits: int = 64) -> Column:
    """The key of a string: the highest ``bits`` bits of its xxhash (fewer in tests, to have collisions)."""
    return F.xxhash64(text) if bits == 64 else F.shiftrightunsigned(F.xxhash64(text), 64 - bits)


class Published(NamedTuple):
    """What a task opens an array by."""

    bits: int
    part_bits: int
    files: tuple[str, ...]


def publish(entries: DataFrame, name: str, bits: int = 64, part_bytes: int = PART_BYTES) -> Published:
    """Build the array of ``entries`` and send it to the executors.

    ``entries``: key (a long of ``bits`` bits, taken as unsigned), text and payload (string
    or binary, not null).  It is read twice and should be a staged table.
    """
    spark = entries.sparkSession
    held = F.octet_length("text") + F.octet_length("payload") + 3 * HEADER
    total = entries.agg(F.sum(held.cast("long")).alias("n")).first()["n"] or 0
    part_bits = min(max(int(-(-total // part_bytes)) - 1, 0).bit_length(), bits, 20)
    # Spark's shift takes the distance modulo 64, so no bits at all are a case of their own
    part = F.shiftrightunsigned("key", bits - part_bits).cast("int") if part_bits else F.lit(0)
    keyed = entries.select("key", F.col("text").cast("binary").alias("text"),
                           F.col("payload").cast("binary").alias("payload"), part.alias("part"))

    def pack(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("key").to_numpy().view(np.uint64), kind="stable")
        group = group.take(pa.array(order)).combine_chunks()
        keys = group.column("key").to_numpy().view(np.uint64)
        parts = [np.array([group.column("part")[0].as_py(), len(keys)], np.int64).tobytes(), keys.tobytes()]
        blobs = []
        for column in ("text", "payload"):
            values = group.column(column).to_pylist()
            parts.append(np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int64).tobytes())
            blobs += values
        return pa.table({"blob": pa.array([b"".join(parts + blobs)], pa.binary())})

    packed = keyed.groupBy("part").applyInArrow(pack, "blob binary")
    path = scratch_path(spark, name)
    packed.select(F.col("blob").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    files = _files(spark, path)
    for file in files:
        spark.sparkContext.addFile(file)
    return Published(bits, part_bits, tuple(os.path.basename(f) for f in files))


def _files(spark: SparkSession, path: str) -> list[str]:
    """The files with data in a folder of any file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(f.getPath().toString() for f in found if f.getLen() and f.getPath().getName().startswith("part-"))


class Part(NamedTuple):
    """One mapped file."""

    keys: np.ndarray
    texts: np.ndarray       # where each text begins in ``blob``
    payloads: np.ndarray    # where each payload begins, counted from ``after``
    blob: np.ndarray
    after: int


class DigestArray:
    """A published array, opened in a task."""

    def __init__(self, name: Published):
        self.bits, self.part_bits = name.bits, name.part_bits
        self.parts: dict[int, Part] = dict(_mapped(SparkFiles.get(f)) for f in name.files)
        # entries are numbered from 0 in the order of their keys
        sizes = [len(self.parts[k].keys) if k in self.parts else 0 for k in range(1 << self.part_bits)]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.first[-1])

    def _by_part(self, keys: np.ndarray) -> Iterator[tuple[int, Part, np.ndarray]]:
        if not self.part_bits:
            where = np.zeros(len(keys), np.uint64)
        else:
            where = keys >> np.uint64(self.bits - self.part_bits)
        for number in np.unique(where).tolist():
            if number in self.parts:
                yield number, self.parts[number], np.flatnonzero(where == number)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key's first entry, -1 if there is none."""
        out = np.full(len(keys), -1, np.int64)
        for number, part, probes in self._by_part(keys):
            at = np.searchsorted(part.keys, keys[probes])
            inside = at < len(part.keys)
            inside[inside] = part.keys[at[inside]] == keys[probes[inside]]
            out[probes[inside]] = self.first[number] + at[inside]
        return out

    def entry(self, number: int) -> tuple[bytes, bytes]:
        """(text, payload) of an entry."""
        k = int(np.searchsorted(self.first, number, "right")) - 1
        part, at = self.parts[k], number - int(self.first[k])
        lo, hi = part.payloads[at:at + 2].tolist()
        return (part.blob[part.texts[at]:part.texts[at + 1]].tobytes(),
                part.blob[part.after + lo:part.after + hi].tobytes())

    def find(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray,
             sizes: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """(probes that are held, their payloads), part by part.

        Probe i has the key ``keys[i]`` and the bytes ``data[starts[i]:][:sizes[i]]``; what
        the binary search finds is held only if the stored string is the same.
        """
        for _, part, probes in self._by_part(keys):
            at = np.searchsorted(part.keys, keys[probes])
            # strings that share a key stand next to each other
            while len(probes):
                inside = at < len(part.keys)
                inside[inside] = part.keys[at[inside]] == keys[probes[inside]]
                probes, at = probes[inside], at[inside]
                begin = part.texts[at]
                same = _same(data, starts[probes], sizes[probes], part.blob, begin, part.texts[at + 1] - begin)
                if same.any():
                    a, b = (part.after + part.payloads[at[same] + k] for k in (0, 1))
                    yield probes[same], [part.blob[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                probes, at = probes[~same], at[~same] + 1


def _mapped(path: str) -> tuple[int, Part]:
    file = np.memmap(path, np.uint8, "r")
    number, n = file[:2 * HEADER].view(np.int64).tolist()
    cuts = np.cumsum([2 * HEADER, HEADER * n, HEADER * (n + 1), HEADER * (n + 1)])
    keys, texts, payloads = (file[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
    texts = texts.view(np.int64)
    return number, Part(keys.view(np.uint64), texts, payloads.view(np.int64), file[cuts[-1]:], int(texts[-1]))


def _same(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, other: np.ndarray,
          other_starts: np.ndarray, other_sizes: np.ndarray) -> np.ndarray:
    """Which strings of ``data`` equal their counterpart in ``other``."""
    same = sizes == other_sizes
    rows = np.flatnonzero(same & (sizes > 0))
    if len(rows):
        n = sizes[rows]
        first = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(first, n)
        equal = data[np.repeat(starts[rows], n) + step] == other[np.repeat(other_starts[rows], n) + step]
        same[rows] = np.logical_and.reduceat(equal, first)
    return same
