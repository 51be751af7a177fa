"""URL filters over a sorted digest array.

A rule names a host and the beginning of a path and allows or blocks what fits:
its host and all subdomains of it, paths that begin so.  The longest rule that
fits decides.  Rules are kept in two digest arrays (see :mod:`digests`): the
hosts that have rules, each with the lengths of its rules' paths, and the rules
themselves.  A url probes the first with the ends of its host and the second
with (end of the host, beginning of the path) of just those lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.digests import DigestArray, digest, publish, text_key
from claimflow.llm.scratch import Scratch, scratch
from claimflow.llm.words import text_bytes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDRESS = r"://([^/?#]*)([^?#]*)"

# The rules of the registered query, (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, ADDRESS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


class Filter:
    """Published rules."""

    def __init__(self, run: Scratch, rules: DataFrame, bits: int = 64):
        """``rules``: host, path, verdict (allow or block).

        Hosts are lower-cased, a null path is empty and fits every path.  Rows with
        another verdict, without a host, with ``/``, ``?`` or ``#`` in the host or
        with a path that begins otherwise than with ``/`` can fit no url and are
        left out.  Of equal rules with both verdicts the block counts.
        """
        host = F.translate("host", UPPER, LOWER)
        path = F.coalesce("path", F.lit(""))
        usable = F.col("verdict").isin("allow", "block") & host.rlike("^[^/?#]+$") & path.rlike("^($|/)")
        kept = rules.select("host", "path", "verdict").filter(usable).select(host.alias("host"), path.alias("path"), "verdict")
        kept = run.stage(kept.groupBy("host", "path").agg(F.max("verdict").alias("verdict")), "rules")
        # the dots of a rule's host bound how many ends of a url's host are worth a probe
        self.labels = kept.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"] or 0
        lengths = kept.groupBy("host").agg(F.sort_array(F.collect_set(F.octet_length("path"))).alias("lengths"))
        hosts = lengths.select(text_key(F.col("host"), bits).alias("key"), F.col("host").alias("text"), F.concat_ws(
            ",", F.transform("lengths", lambda n: n.cast("string"))).alias("payload"))
        self.hosts = publish(run.stage(hosts, "hosts"), "url-hosts", bits)
        whole = F.concat("host", "path")
        self.rules = publish(run.stage(kept.select(text_key(whole, bits).alias("key"), whole.alias("text"),
                                                   F.col("verdict").alias("payload")), "whole"), "url-rules", bits)
        self.bits = bits

    def ends(self, host: Column) -> Column:
        """(key, start) of the ends of a host that follow a dot, and of the host itself."""
        labels = F.least(F.size(F.split(host, r"\.")), F.lit(self.labels))

        def end(k: Column) -> Column:
            text = F.call_function("substring_index", host, F.lit("."), -k)
            return F.struct(text_key(text, self.bits).alias("key"), (F.octet_length(host) - F.octet_length(text)).alias("start"))

        none = F.array().cast("array<struct<key:bigint,start:int>>")
        return F.when((host != "") & (labels > 0), F.transform(F.sequence(F.lit(1), labels), end)).otherwise(none)

    def judge(self, table: DataFrame, id_col: str = "page_id", url_col: str = "url",
              otherwise: str = "allow") -> DataFrame:
        """One row per row of ``table``: id, host, path, rule, verdict.

        ``rule`` is the host and path of the longest rule (in bytes) that fits, null if none
        does; then the verdict is ``otherwise``: the array lists what is ruled, all else
        passes.  A url that is null or has no ``://`` has an empty host and path, and
        no rule fits it.  Repeated rows are judged each; other columns are not read.
        """
        asked = table.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
        asked = asked.withColumn("ends", self.ends(F.col("host")))
        kind = dict(asked.dtypes)[id_col]
        names = (self.hosts, self.rules, self.bits)

        def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hosts, rules = DigestArray(names[0]), DigestArray(names[1])
            for batch in batches:
                rule, verdict = _judged(batch, hosts, rules, names[2], otherwise)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], rule, verdict],
                                                 [id_col, "host", "path", "rule", "verdict"])

        return asked.mapInArrow(judged, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def _judged(batch: pa.RecordBatch, hosts: DigestArray, rules: DigestArray, bits: int,
            otherwise: str) -> tuple[pa.Array, pa.Array]:
    host, host_at = text_bytes(batch.column(1))
    path, path_at = text_bytes(batch.column(2))
    ends = batch.column(3)
    row = np.repeat(np.arange(batch.num_rows), ends.value_lengths().to_numpy(zero_copy_only=False))
    keys, start = (ends.flatten().field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    keys, starts = keys.astype(np.int64).view(np.uint64), host_at[row] + start
    found_rows, probes = [], []
    known: dict[bytes, int] = {}
    for hit, payloads in hosts.find(keys, host, starts, host_at[row + 1] - starts):
        for k, r, lengths in zip(hit.tolist(), row[hit].tolist(), payloads, strict=True):
            end = host[starts[k]:host_at[r + 1]].tobytes()
            begin, size = int(path_at[r]), int(path_at[r + 1] - path_at[r])
            for n in map(int, lengths.split(b",")):
                if n <= size:
                    probe = end + path[begin:begin + n].tobytes()
                    if probe not in known:
                        known[probe] = digest(probe, bits)
                    found_rows.append(r)
                    probes.append(probe)
    rule: list[bytes | None] = [None] * batch.num_rows
    verdict: list[str] = [otherwise] * batch.num_rows
    if probes:
        sizes = np.array([len(p) for p in probes], np.int64)
        whole = np.frombuffer(b"".join(probes), np.uint8)
        keys = np.array([known[p] for p in probes], np.uint64)
        for hit, payloads in rules.find(keys, whole, np.cumsum(sizes) - sizes, sizes):
            for k, said in zip(hit.tolist(), payloads, strict=True):
                r = found_rows[k]
                # rules that fit one url have different hosts or different paths, and of
                # two equally long ones the one with the longer host is the nearer one
                if rule[r] is None or _rank(probes[k]) > _rank(rule[r]):
                    rule[r], verdict[r] = probes[k], said.decode()
    return pa.array([None if x is None else x.decode() for x in rule], pa.string()), pa.array(verdict, pa.string())


def _rank(rule: bytes) -> tuple[int, int]:
    return len(rule), len(rule.partition(b"/")[0])


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url with the rule that decides and the verdict."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    with scratch(spark) as run:
        rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
        return run.result(Filter(run, rules).judge(pages), "op11")


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
OP11_SQL = f"""
    WITH parts AS (
        SELECT row_number() OVER () AS no, page_id,
               translate(coalesce(regexp_extract(url, '{ADDRESS}', 1), ''), '{UPPER}', '{LOWER}') AS host,
               coalesce(regexp_extract(url, '{ADDRESS}', 2), '') AS path
        FROM pages),
    rules(rule_host, rule_path, verdict) AS (VALUES {_VALUES}),
    fitting AS (
        SELECT no, rule_host || rule_path AS rule, verdict, row_number() OVER (
                   PARTITION BY no ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS rn
        FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM parts LEFT JOIN fitting ON parts.no = fitting.no AND rn = 1"""
