"""Cases that cut-down versions of the operators get wrong."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import backoff_scores, edit_distance
from pyspark.sql import functions as F

from claimflow.llm import ann, exact, lines, lm, minhash


def test_near_lines_of_every_length(spark, run):
    rng = random.Random(11)
    texts = {"Le | treque.", "Le treque.", "a", "é", "ab", "zz", "q"}
    for length in range(1, 24):
        for _ in range(12):
            line = "".join(rng.choice("abcdefé ") for _ in range(length))
            other = list(line)
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(other) + 1)
                other[k:k + rng.randint(0, 1)] = rng.choice(["", "x", "b"])
            texts |= {line, "".join(other)}
    texts = sorted(texts - {""})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near = defaultdict(set)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            if abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2:
                near[i].add(j)
                near[j].add(i)
    want = {}
    for i in range(len(texts)):
        seen, todo = {i}, [i]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        want[i] = (len(near[i]), min(seen))
    got = {r["doc_id"]: (r["links"], r["class_doc_id"]) for r in lines.near_lines(run, docs).collect()}
    assert got == want
    assert sum(1 for i, x in enumerate(texts) if len(x) < 16 and near[i]) > 100
    assert texts.index("Le treque.") in near[texts.index("Le | treque.")]


def test_no_range_holds_a_common_gram(spark, run, monkeypatch):
    rng = random.Random(3)
    texts = ["a b " * 40 + " ".join(f"w{rng.randrange(4000)}" for _ in range(80)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    seen, real = [], lm.join_counts

    def spy(exploded):
        seen.append(exploded)
        return real(exploded)

    monkeypatch.setattr(lm, "join_counts", spy)
    monkeypatch.setattr(lm, "SLICE_BYTES", 1000)
    got = {r["doc_id"]: (r["words"], tuple(r["hits"]), r["score_micro"]) for r in lm.score_corpus(run, docs).collect()}
    assert got == dict(enumerate(backoff_scores(texts, 3)))
    [exploded] = seen
    asked = Counter()
    for r in exploded.collect():
        asked.update(lm._unpack_grams(r["grams"], r["n"]).tolist())
    hot = set(lm.asked(lm.grams(pa.array(["a b a b"]), 3))[0].tolist())
    assert len(hot) == 6 and not hot & set(asked)
    assert max(asked.values()) < 200


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_just_similar_enough_share_a_band(spark, percent):
    """Of the bands that the operator writes: how many, and how often one is shared at the threshold."""
    size, pairs = {80: (5, 500), 85: (3, 300)}[percent]
    rng = random.Random(percent)
    texts = []
    for k in range(2 * pairs):  # pairs of 400 shingles; the last words differ, so percent of the union is shared
        if k % 2 == 0:
            words = [f"w{rng.random()}" for _ in range(400 + size - 1)]
            texts.append(" ".join(words))
        else:
            same = round(800 * percent / (100 + percent)) + size - 1
            texts.append(" ".join(words[:same] + [f"v{rng.random()}" for _ in range(400 + size - 1 - same)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []

    class Staged(Exception):
        pass

    class Run:
        def stage(self, df, name):
            seen.append(df.collect())
            raise Staged

    with pytest.raises(Staged):
        minhash.near_duplicates(Run(), docs, size, percent)
    bands = {r["doc_id"]: np.array(r["bands"]) for r in seen[0]}
    shared = np.mean([(bands[k] == bands[k + 1]).mean() for k in range(0, 2 * pairs, 2)])
    assert (1 - shared) ** len(bands[0]) < 5e-5


def test_layout_misses_as_little_at_every_threshold():
    assert minhash.layout(85) == (24, 6) and minhash.layout(80) == (29, 5)
    for percent in range(10, 100):
        bands, rows = minhash.layout(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.MISSED and bands * rows <= minhash.MOST


def test_exact_dedup_meets_a_filled_index(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    rows = [(k, f"text {rng.randrange(40)}") for k in range(200)] + [(None, "text 1"), (None, "only null"), (7, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    held, real = [], exact.DigestIndex.unseen

    def spy(index, groups):
        held.append(index.read().count())
        return real(index, groups)

    monkeypatch.setattr(exact.DigestIndex, "unseen", spy)
    got = exact.op4_exact_dedup(spark, str(tmp_path)).collect()
    assert len(held) > 1 and held[0] == 0 and all(held[1:])
    first, size = {}, defaultdict(int)
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(t, i)
        size[t] += 1
    want = sorted(repr((i, first[t], size[t], i == first[t])) for i, t in rows)
    assert sorted(repr((r["doc_id"], r["keep_id"], r["group_size"], r["kept"])) for r in got) == want


def test_whole_search_recall_against_brute_force(spark, run):
    rng = np.random.default_rng(12)
    data = rng.standard_normal((4000, 64)).astype(np.float32)
    data /= np.linalg.norm(data, axis=1)[:, None]
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for r in ann.search(run, table, F.col("vec_id") % 100 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    assert len(got) == 40 and all(len(x) == 10 for x in got.values())
    wide, hit = data.astype(float), 0
    for q, found in got.items():
        far = ((wide - wide[q]) ** 2).sum(1)
        far[q] = np.inf
        hit += len(found & set(np.argsort(far)[:10].tolist()))
    assert 0.9 <= hit / 400


def test_repeated_rows_are_compared_once(spark, run, monkeypatch):
    rng = random.Random(17)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(100)]
    one, two = " ".join(words), " ".join([*words[:99], "other"])
    far = " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(100))
    rows = [(1, one), (2, two), (3, two + " x")] * 1000 + [(4, far), (3, far)]
    seen, real = [], minhash._agreeing

    def spy(run_, pairs, sketches):
        seen.append((pairs.count(), sketches.count()))
        return real(run_, pairs, sketches)

    monkeypatch.setattr(minhash, "_agreeing", spy)
    found = minhash.near_duplicates(run, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(1, 1), (2, 1), (3, 1), (4, 1)}
    [(pairs, classes)] = seen       # three similar classes make at most three pairs
    assert pairs <= 3 and classes == 4


def test_backoff_texts_are_moved_once(spark):
    """The slices lie in buckets: only what is asked and what is counted is shuffled."""
    from claimflow.llm.scratch import scratch

    docs = spark.createDataFrame([(k, f"a b c{k % 3} d") for k in range(20)], "doc_id long, text string")
    with scratch(spark) as run:
        plan = lm.score_corpus(run, docs)._jdf.queryExecution().executedPlan().toString()
        tables = list(run.tables)
        assert all(spark.catalog.tableExists(t) for t in tables)
    assert plan.count("Exchange hashpartitioning(base") == 1
    assert plan.count("Exchange ") == 2
    assert tables and not any(spark.catalog.tableExists(t) for t in tables)


def test_near_line_keys_are_made_by_small_code(spark):
    """The JVM compiles no method of more than 8,000 bytes; the keys' code was larger."""
    rows = spark.range(10).selectExpr("id", "cast(id as string) as line", "id as parities")
    for kinds in (lines.index_kinds(lines.EDITS), lines.probe_kinds(lines.EDITS)):
        plan = lines.keyed(rows, kinds, lines.EDITS)._jdf.queryExecution().executedPlan()
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
        assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def test_parities_of_lines_within_reach(spark):
    """No line within reach is left out by the ends' parities, wherever the edits are."""
    rng, pairs = random.Random(5), []
    for _ in range(400):
        a = [rng.choice("abcdé漢🙂 ") for _ in range(rng.choice([1, 3, 31, 32, 33, 40, 90]))]
        b = list(a)
        for _ in range(rng.randint(1, 2)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randint(0, 1)] = rng.choice([[], ["x"], ["é"]])
        pairs.append(("".join(a), "".join(b)))
    frame = spark.createDataFrame(pairs, "a string, b string").filter("b <> ''")
    x, y = lines.parities(F.col("a")), lines.parities(F.col("b"))
    whole = F.bit_count(lines.odd(F.col("a"), 62).bitwiseXOR(lines.odd(F.col("b"), 62)))
    assert frame.filter(~lines.alike(x, y, 2) | (whole > 4)).count() == 0
    far = lines.alike(lines.parities(F.lit("the quick brown fox")), lines.parities(F.lit("jumped over 97 dogs")), 2)
    assert not frame.select(far.alias("near")).first()["near"]


def test_near_lines_of_long_lines(spark, run):
    """Lines at the borders of spans, with both edits anywhere, with and without spaces."""
    rng, texts = random.Random(17), set()
    for length in (*range(60, 70), *range(93, 99), 127, 128, 129, 130, 161):
        for letters in ("abcdefé  ", "xyz漢"):
            for _ in range(4):
                line = "".join(rng.choice(letters) for _ in range(length))
                texts.add(line)
                for _ in range(5):
                    other = list(line)
                    for _ in range(rng.randint(1, 3)):
                        k = rng.randrange(len(other) + 1)
                        other[k:k + rng.randint(0, 1)] = rng.choice(["", "q", " "])
                    texts.add("".join(other))
    texts = sorted(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    links = Counter()
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            if abs(len(a) - len(b)) <= 2 and sum((Counter(a) - Counter(b)).values()) <= 2 and edit_distance(a, b) <= 2:
                links[i] += 1
                links[j] += 1
    got = {r["doc_id"]: r["links"] for r in lines.near_lines(run, docs).collect()}
    assert got == {i: links[i] for i in range(len(texts))}
    assert sum(links.values()) > 500


def test_long_line_keys_are_few_and_made_by_small_code(spark):
    rng = random.Random(4)
    words = [" ".join("".join(rng.choice("abcdeg") for _ in range(rng.randint(2, 8))) for _ in range(50)) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(words)), "id long, line string")
    keys = lines.long_keys(rows, lines.EDITS)
    assert keys.count() < 4.5 * len(words)
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(keys._jdf.queryExecution().executedPlan())
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def test_lines_alike_in_one_place_make_few_pairs(spark, run):
    """Half of all pairs shared a segment and had the same ends: n * n / 2 pairs, all far apart."""
    rng = random.Random(8)
    start, end = ("".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(2))
    texts = [start + "".join(rng.choice("abcdefgh ") for _ in range(40)) + end for _ in range(200)]
    docs = spark.createDataFrame([(0, "\n".join(texts))], "doc_id long, text string")
    named = lines.named_lines(run, docs, lines.EDITS)
    assert lines.long_pairs(run, named, lines.EDITS).count() < 200


def test_near_lines_shuffle_their_texts_once(spark, run):
    docs = spark.createDataFrame([(k, f"line {k} " * 20) for k in range(50)], "doc_id long, text string")
    named = lines.named_lines(run, docs, lines.EDITS)
    ids = run.stage(named.select("id").limit(5), "some")
    plan = named.select("id", "line").join(ids.hint("merge"), "id", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1    # of the ids
    assert named.count() == 50


def test_lines_whose_hashes_meet_get_others(spark, run, monkeypatch):
    seen, real = [], lines.distinct_lines

    def meeting(docs, seed=0):
        seen.append(seed)
        found = real(docs, seed)
        return found.withColumn("alone", F.lit(False)) if not seed else found

    monkeypatch.setattr(lines, "distinct_lines", meeting)
    docs = spark.createDataFrame([(1, "a b c d e f g\nanother line")], "doc_id long, text string")
    assert lines.named_lines(run, docs, lines.EDITS).count() == 2
    assert seen == [0, 1]
