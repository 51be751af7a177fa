"""Connected components of a link table, with joins and aggregates only.

Alternating star contraction: every node hands its larger neighbours (then its
smaller ones) to the smallest node it knows, until each node is linked to the
smallest node of its component and nothing else.  The rounds grow with the
logarithm of the longest path, the edges never grow beyond the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.joins import lookup
from claimflow.llm.scratch import Scratch


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _star(run: Scratch, pairs: DataFrame, stage: str) -> DataFrame:
    """(node, other) pairs -> (node, other, smallest of node and its others)."""
    pairs = run.stage(pairs, f"{stage}-pairs")
    least = run.stage(
        pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        .select("u", F.least("u", "m").alias("m"), "n"), f"{stage}-least")
    return lookup(pairs, least, ["u"], "n")


def _edges(pairs: DataFrame) -> DataFrame:
    """Directed from larger to smaller, loops and repeats removed."""
    return (pairs.filter("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def components(run: Scratch, links: DataFrame) -> DataFrame:
    """(a, b) links of integer ids -> (node, root): each linked node with the
    smallest node that it reaches.

    Loops, repeats and either direction of a link are allowed; a link with a
    null end is no link; no links give no rows.
    """
    edges = run.stage(_edges(links.select("a", "b").dropna()), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        wide = _star(run, both, "large").filter("v > u").select(F.col("v").alias("a"),
                                                               F.col("m").alias("b"))
        large = _edges(wide).select(F.col("a").alias("u"), F.col("b").alias("v"))
        near = _star(run, large, "small")
        pairs = near.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            near.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = run.stage(_edges(pairs), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
