"""Hard negatives: brute force with ties, copies and odd vectors; the tree's elimination; empty tables."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimflow.llm import negatives

ROWS = "vec_id long, embedding array<double>, label int, class string, ids string, leaf string, score string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "i", "l", "s", "n") for r in rows], ROWS)


def brute(rows, every):
    usable = set()
    for i, x, label in rows:
        if i is None or label is None or x is None or any(v is None or not np.isfinite(v) for v in x):
            continue
        v = tuple(int(np.floor(256 * a)) for a in x)
        if max(map(abs, v), default=0) > negatives.LARGEST:
            continue
        usable.add((i, (label + 1) % 10 if i % 7 == 0 else label, v))
    lengths = defaultdict(list)
    for r in usable:
        lengths[len(r[2])].append(r)
    out = []
    for mine in lengths.values():
        for anchor in mine:
            if anchor[0] % every:
                continue
            scored = sorted((-sum(a * b for a, b in zip(anchor[2], v, strict=True)), i, label, v)
                            for i, label, v in mine if (i, label, v) != anchor)
            for p, i, *_ in [s for s in scored if s[2] == anchor[1]][:5]:
                found = [s for s in scored if s[2] != anchor[1] and -30 * p <= -100 * s[0] <= -90 * p][:10]
                out += [(anchor[0], i, rank, s[1], -p, -s[0]) for rank, s in enumerate(found, 1)]
    return sorted(out)


def some_rows(n=500, dims=6, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(8)]
    rows = [(k, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)], rng.randrange(4)) for k in range(n)]
    hot = rows[7][1]
    rows += [(n + k, hot, rng.randrange(3)) for k in range(300)]                                # a third are one vector
    rows += [rows[20], rows[20], (20, rows[21][1], rows[20][2]), (100, rows[5][1], 1), (-20, rows[3][1], 2)]
    rows += [(2000, None, 1), (2020, [0.1] * dims, None), (None, hot, 1), (2040, [None, *hot[1:]], 1),
             (2060, [float("nan"), *hot[1:]], 1), (2080, [float("inf"), *hot[1:]], 1), (2100, [1e300, *hot[1:]], 1),
             (2120, [0.0] * dims, 1), (2121, [0.0] * dims, 2), (2140, [], 1), (2141, [], 1), (2142, [], 2),
             (2160, [0.5], 1), (2161, [0.9], 1), (2162, [0.4], 3), (2180, [0.5, 0.5], 1), (2200, [1000.0] * dims, 3)]
    return rows


@pytest.mark.parametrize("every", [20, 1000])
def test_negatives_equal_brute_force(spark, run, every):
    rows = some_rows()
    got = negatives.mine(run, negatives.usable_rows(frame(spark, rows)), F.col("vec_id") % every == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    want = brute(rows, every)
    assert len(want) > 20
    assert sorted(map(tuple, got.collect())) == want


def test_small_groups_and_blocks_give_the_same(spark, run, monkeypatch):
    monkeypatch.setattr(negatives, "GROUP", (20, 40))
    monkeypatch.setattr(negatives, "QUERIES", 7)
    rows = some_rows(300, 3)
    got = negatives.mine(run, negatives.usable_rows(frame(spark, rows)), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def _measured(tree, rows):
    n = len(tree.below)
    low, high = np.full((n, negatives.ARITY + 1), np.inf), np.full((n, negatives.ARITY + 1), -np.inf)
    for _, mine, to, own in negatives.descend(tree, rows):
        for k, split in zip(mine, own, strict=True):
            values = [*to[list(mine).index(k)], *[np.nan] * (negatives.ARITY - to.shape[1]), (rows[k] ** 2).sum()]
            low[split], high[split] = np.fmin(low[split], values), np.fmax(high[split], values)
    return negatives.Ranges(low[:, :-1], high[:, :-1], low[:, -1], high[:, -1])


def test_elimination_is_safe_and_eliminates():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 200, (30, 4))
    rows = np.floor(centres[rng.integers(0, 30, 1500)] + rng.normal(0, 10, (1500, 4)))
    tree = negatives.grow(rows[:700], 2)
    assert tree.leaves > negatives.ARITY
    ranges, leaf = _measured(tree, rows), negatives.leaf_of(tree, rows)
    asking = np.floor(rng.normal(0, 200, (60, 4)))
    scores = asking @ rows.T
    low = np.quantile(scores, [0.5, 0.97], axis=1).T
    high = np.quantile(scores, [0.55, 1.0], axis=1).T
    alive = negatives.survivors(tree, ranges, asking, low, high)
    for k in range(60):
        held = [((scores[k] >= low[k, w]) & (scores[k] <= high[k, w])) for w in range(2)]
        assert alive[k, np.unique(leaf[held[0] | held[1]])].all()
    assert alive.mean() < 0.7


def test_no_rows(spark, run):
    for rows in ([], [(None, None, None)], [(20, [1.0], 1)]):
        assert negatives.mine(run, negatives.usable_rows(frame(spark, rows)), F.col("vec_id") % 20 == 0).count() == 0
