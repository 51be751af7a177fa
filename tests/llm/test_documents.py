"""Operators on the documents table against brute force, awkward rows included."""

import hashlib
import random
import tracemalloc
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import WORDS, backoff_scores, near_components, shingle_set

from claimflow.llm import exact, lm, minhash, mixing, packing, quality


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup_keeps_one_row_of_each_text(spark, run, awkward):
    rows, docs = awkward
    index = exact.new_index(spark)
    try:
        got = exact.dedup(run, docs, index).collect()
        groups = defaultdict(list)
        for i, t, _ in rows:
            groups[hashlib.sha256(norm(t).encode()).digest()].append(i)
        assert len(got) == len(rows)
        for r in got:
            ids = groups[bytes(r["digest"])]
            named = [i for i in ids if i is not None]
            assert r["group_size"] == len(ids)
            assert r["keep_id"] == (min(named) if named else None)
        kept = Counter(bytes(r["digest"]) for r in got if r["kept"])
        assert set(kept) == set(groups) and set(kept.values()) == {1}
        # a second batch is deduplicated against the index and appended to it
        more = spark.createDataFrame([(900, rows[0][1]), (901, "new  text"), (902, "new text")], "doc_id long, text string")
        again = {r["doc_id"]: r for r in exact.dedup(run, more, index).collect()}
        assert again[900]["keep_id"] == 0 and not again[900]["kept"]
        assert again[901]["kept"] and not again[902]["kept"] and again[902]["keep_id"] == 901
        assert index.read().count() == len(groups) + 1
    finally:
        index.drop()


def test_exact_index_is_read_without_a_shuffle(spark, run):
    index = exact.new_index(spark)
    try:
        new = run.stage(spark.range(50).selectExpr("id AS keep_id", "unhex(sha2(cast(id AS string), 256)) AS digest"), "new")
        index.append(new, "one")
        plan = index.unseen(new)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
        assert index.unseen(new).count() == 0
    finally:
        index.drop()


def test_exact_index_survives_an_empty_catalog(spark, run):
    path = run.path("index")
    first = exact.DigestIndex(spark, "digests_first", 4, path).open()
    rows = run.stage(spark.range(9).selectExpr("id AS keep_id", "unhex(sha2(cast(id AS string), 256)) AS digest"), "rows")
    first.append(rows, "one")
    first.drop()  # the table had its own location: the files stay
    second = exact.DigestIndex(spark, "digests_second", 4, path).open()
    try:
        assert second.unseen(rows).count() == 0
    finally:
        second.drop()


def test_exact_stage_keeps_clashing_columns(spark, awkward):
    rows, docs = awkward
    out = exact.stage_exact_dedup(spark, docs, "")
    assert out.columns == docs.columns
    texts = Counter(norm(r["text"]) for r in out.collect())
    assert set(texts.values()) == {1} and set(texts) == {norm(t) for _, t, _ in rows}


def test_mix_meets_targets_with_whole_copies(spark, run, awkward):
    rows, docs = awkward
    got = mixing.mix(run, docs).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(WORDS.findall(t or ""))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    goal, stopped = 1.5 * sum(size.values()), set()
    while True:  # share, stop those above, share again
        left = goal - sum(2 * size[s] for s in stopped)
        level = left / sum(weight[s] for s in order if s not in stopped)
        above = {s for s in order if s not in stopped and weight[s] * level > 2 * size[s]}
        if not above:
            break
        stopped |= above
    taken, largest = Counter(), Counter()
    for r in got:
        s = r["source"]
        assert r["source_size"] == size[s] and r["copies"] in (0, 1, 2)
        assert r["target"] == pytest.approx(2 * size[s] if s in stopped else weight[s] * level)
        taken[s] += r["copies"] * r["size"]
        largest[s] = max(largest[s], r["size"])
    for r in got:
        # the largest text is half of its source; the others come within a few words
        assert abs(taken[r["source"]] - r["target"]) <= (0.02 * r["target"] if r["source"] != "hot" else largest["hot"])
    again = sorted(map(str, mixing.mix(run, docs.repartition(5)).collect()))
    assert again == sorted(map(str, got))


def test_mix_is_fair(spark, run):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', 1 + id % 7) AS text",
                                        "cast(id % 2 AS string) AS source")
    got = mixing.mix(run, docs, seed=3).groupBy("source", "size").avg("copies").collect()
    share = {r["source"]: r["target"] / r["source_size"] for r in mixing.mix(run, docs).collect()}
    for r in got:
        assert r["avg(copies)"] == pytest.approx(share[r["source"]], abs=0.1)


def test_mix_of_few_documents_comes_near_the_target(spark, run):
    """Sources of ten documents, one of which holds a third or more of the words."""
    rng = random.Random(8)
    rows = []
    for s in range(12):
        sizes = [rng.randint(20, 900) for _ in range(9)]
        rows += [(100 * s + k, "w " * n, f"s{s:02}") for k, n in enumerate([*sizes, sum(sizes) // 2])]
    got = mixing.mix(run, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    for s, n in target.items():
        assert abs(taken[s] - n) <= 0.02 * n, s


def test_stages_keep_the_values_of_clashing_columns(spark):
    names = ["digest", "copies", "mix_id", "mix_source", "mix_size", "words", "c0", "size", "keep_id", "component_id"]
    rows = [(k, f"text {(k or 0) % 7} " * 9, "ab"[(k or 0) % 2], *[f"{n}{k}" for n in names]) for k in (*range(40), 3, 3, None)]
    rows.append((5, "another text", "b", *[f"{n}x" for n in names]))
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long, text string, source string", *[f"{n} string" for n in names]]))
    exact_rows = exact.stage_exact_dedup(spark, docs, "")
    mixed = mixing.stage_mix(spark, docs, "")
    near = minhash.stage_near_dedup(spark, docs, "")
    assert exact_rows.columns == mixed.columns == near.columns == docs.columns
    kept = Counter(map(tuple, exact_rows.collect()))
    assert set(kept) <= set(rows) and len({r[1] for r in kept}) == 8 == sum(kept.values())
    taken = Counter(map(tuple, mixed.collect()))
    assert taken and set(taken) <= set(rows)
    assert set(map(tuple, near.collect())) <= set(rows)


def test_near_duplicates_against_all_pairs(spark, run, awkward):
    rows, docs = awkward
    for size, percent in ((3, 85), (5, 80)):
        want = near_components(rows, size, percent)
        got = minhash.near_duplicates(run, docs, size, percent).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["component_id"] == want.get(r["doc_id"])
        named = Counter((r["doc_id"], r["n_shingles"]) for r in got)
        assert named == Counter((i, len(shingle_set(t, size))) for i, t, _ in rows)


def test_leftover_buckets_are_compared_in_full(spark, run, monkeypatch):
    """A chain whose ends differ: stars alone may miss links, the second round does not."""
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(40):  # each text replaces ten words more than the one before
        rows.append((i, " ".join([f"x{k}" if k < 4 * i else w for k, w in enumerate(words)]), "a"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "PER_KEY", 2)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(run, docs).collect()}
    assert got == near_components(rows, 3, 85)


def test_family_just_under_the_threshold_makes_few_pairs(spark, run, monkeypatch):
    """All texts share 83 percent: no two of them are linked, nor met for what all of them share."""
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(400):
        own = list(base)
        for k in range(9):
            own[30 * k + 7] = f"x{i}y{k}"
        rows.append((i, " ".join(own), "a"))
    for i in range(20):  # near copies of some, which are linked
        rows.append((1000 + i, rows[i][1].replace("w299", f"z{i}"), "a"))
    tried, real = {}, minhash.confirm

    def spy(run_, docs_, pairs, size, percent, tag):
        tried[tag] = pairs.count()
        return real(run_, docs_, pairs, size, percent, tag)

    monkeypatch.setattr(minhash, "confirm", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(run, docs).collect()}
    assert got == near_components(rows, 3, 85) and got[1003] == 3
    assert tried["leftover"] <= 20


@pytest.mark.parametrize(("percent", "block"), [(85, 512), (85, 2), (60, 3), (100, 512)])
def test_leftover_pairs_hold_every_similar_pair(spark, run, monkeypatch, percent, block):
    """Sets of a few common and rare shingles, in components of their own or of several."""
    rng = random.Random(percent + block)
    found = []
    for k in range(150):
        if k % 3 and found:
            members = set(rng.choice(found)[2])
            for _ in range(rng.randint(0, 3)):
                members.discard(rng.choice(sorted(members)))
                members.add(rng.randrange(60))
        else:
            members = {rng.randrange(60) for _ in range(rng.randint(1, 25))}
        found.append((k, k if k % 5 else 0, sorted(members)))
    sets = spark.createDataFrame([(1000 + k, k, root, s) for k, root, s in found],
                                 "at long, doc_id long, root long, shingles array<long>")
    monkeypatch.setattr(minhash, "BLOCK", block)
    pairs = {tuple(r) for r in minhash.leftover_pairs(run, sets, percent).collect()}
    want = set()
    for i, r, x in found:
        for j, q, y in found[i + 1:]:
            both = len(set(x) & set(y))
            if r != q and 100 * both >= percent * (len(x) + len(y) - both):
                want.add((i, j))
    assert want and want <= pairs


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    two = np.concatenate([one[:350], rng.integers(0, 1 << 63, 50, dtype=np.uint64)])
    agree = (minhash.signature(one) == minhash.signature(two)).mean()
    assert abs(agree - 350 / 450) < 0.12
    assert (minhash.signature(one) == minhash.signature(one[::-1].copy())).all()


def test_pieces_are_the_tokenizers_ids(spark, run, awkward):
    from tokenizers import Tokenizer

    from claimflow.llm.tokens import tokenizer_path

    rows, docs = awkward
    tokenizer = Tokenizer.from_file(tokenizer_path())
    extra = [(500, "It's <|endoftext|> 12 Σ ς ΑΣ ́x don't!! ﬁ", "a")]
    more = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string, s string").select("doc_id", "text"))
    got = packing.pack(run, more, length=64).collect()
    want = Counter()
    for i, t, _ in rows + extra:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for a in range(0, len(ids), 64):
            want[i, a, len(ids[a:a + 64]), zlib.crc32(ids[a:a + 64].tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    used = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
        used += at
    assert sorted(sequences) == list(range(len(sequences)))
    assert used > 0.95 * 64 * len(sequences)


def test_patterns_hold_every_length_once():
    rng = np.random.default_rng(2)
    for top in (1, 3, 40, 64):
        histogram = {int(k): int(n) for k, n in enumerate(rng.integers(0, 50, top + 1)) if k and n}
        packed = packing.patterns(histogram, 64)
        held = Counter()
        for packs, content in packed:
            assert sum(size * n for size, n in content) <= 64
            for size, n in content:
                held[size] += packs * n
        assert held == histogram


def test_classifier_separates_and_scores_empty_texts(spark, run):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        good = i % 3 > 0
        rows.append((i, " ".join(rng.choice(["calm", "river", "stone"] if good else ["BUY!!", "NOW$$", "calm"], 20)), int(good)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, ""), (1001, None), (None, "calm")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (7, None), (9, 1 - rows[9][2])],
                                   "doc_id long, quality int")
    model = quality.train(run, docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert len(got) == 403 and all(0 <= s <= 1 for s in got.values())
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((got[i] > 0.5) == bool(rows[i][2]) for i in held)
    assert got[1000] == got[1001]
    none = quality.train(run, docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    sure = quality.train(run, docs, labels.filter("quality = 1 AND doc_id <> 9"))
    assert min(r["score"] for r in quality.score(docs, sure).collect()) > 0.99


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff_scores_against_a_plain_model(spark, run, awkward, order):
    rows, docs = awkward
    rows = [r for r in rows if r[0] != 204]   # the one word of 1.5 MB tells nothing here
    docs = docs.filter("doc_id IS NULL OR doc_id <> 204")
    want = Counter((i, *x) for (i, _, _), x in zip(rows, backoff_scores([t for _, t, _ in rows], order), strict=True))
    got = Counter((r["doc_id"], r["words"], tuple(r["hits"]), r["score_micro"])
                  for r in lm.score_corpus(run, docs, order).collect())
    assert got == want
    assert order < 2 or sum(n * k[2][-1] for k, n in got.items()) > 100


def test_backoff_scores_without_common_words(spark, run, awkward, monkeypatch):
    _, docs = awkward
    want = Counter(map(repr, lm.score_corpus(run, docs).collect()))
    monkeypatch.setattr(lm, "COMMON", 4)   # nearly every word is rare then
    monkeypatch.setattr(lm, "SLICE_BYTES", 2000)
    monkeypatch.setattr(lm, "RANGE_GRAMS", 5000)
    assert Counter(map(repr, lm.score_corpus(run, docs).collect())) == want


def test_fitting_keeps_little_beside_the_rows():
    """All rows' ratios were kept, twice the rows' size, in small pieces."""
    lists = [np.arange(k % 7, 2500 + k % 7, dtype=np.uint32) for k in range(3000)]
    column = pa.array([x.tobytes() for x in lists], pa.binary())
    labels = np.arange(len(lists)) % 7 // 4
    tracemalloc.start()
    try:
        rows = quality.listed_features(column.slice(10))
        quality.fit(rows, labels[10:])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert all(np.array_equal(x, y) for x, y in zip(rows, lists[10:], strict=True))
    assert len({id(x.base) for x in rows}) == 1
    assert peak < 55e6          # the rows are 30 MB, their ratios 60 MB


def test_feature_lists_may_be_empty():
    assert [len(x) for x in quality.listed_features(pa.array([b"", b""], pa.binary()))] == [0, 0]
    assert [len(x) for x in quality.listed_features(pa.array([b"", bytes(8), b""], pa.binary()))] == [0, 2, 0]
