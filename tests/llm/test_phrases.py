"""Phrase collocations: brute force, the filters' round trip, slices that end inside texts, empty tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimflow.llm import phrases, quotient

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, word string, phrase string, n string, rank string, score string, key string"


def best(rows, least, longest, per_lang, percent=100):
    f, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[k:k + m]) for k in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        often = {w: a for w, a in counts.items() if len(w) > 1 and a >= least}
        around = Counter()
        for w, a in often.items():
            for m in range(2, len(w)):
                for k in range(len(w) - m + 1):
                    around[w[k:k + m]] = max(around[w[k:k + m]], a)
        found = []
        for w, a in often.items():
            if w in around and 100 * around[w] >= percent * a:
                continue
            score, _, l, r = min((1000 * a * total[lang] // (counts[w[:k]] * counts[w[k:]]), k, counts[w[:k]], counts[w[k:]])
                                 for k in range(1, len(w)))
            found.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:per_lang], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def corpus(n=150, seed=3):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "C", "é", "dd", "e\u00a0e", "x\x00y", "zz", "w\u2028v", "long" * 30]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocabulary[:rng.randint(2, 10)]) + rng.choice(["", "", "", "", ",", ".", "\n", "\r", "\t", ";x"])
                 for _ in range(rng.choice([1, 2, 5, 40]))]
        rows.append((rng.choice([" ", "  "]).join(words), rng.choice(["en", "de", None, "und"])))
    rows += [("hot pair, " * 400, "en")] * 3 + [("again and again and again", "en")] * 60
    return rows + [(None, "en"), ("", None), (" \t.,;", "de"), ("word", ""), ("x" * 3000 + " y", "en"), ("no break " * 3000, "fr")]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, g, "w", "p", "n", "r", "s", "k") for k, (t, g) in enumerate(rows)], DOCS)


@pytest.mark.parametrize(("least", "longest", "per_lang", "percent"), [(2, 5, 40, 100), (5, 5, 2000, 100), (3, 3, 7, 60), (9, 2, 5, 100)])
def test_phrases_equal_brute_force(spark, run, least, longest, per_lang, percent):
    rows = corpus()
    got = phrases.collocations(run, frame(spark, rows), least, longest, per_lang, percent)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for _, t in got.dtypes} == {"string", "bigint"}
    assert sorted(map(tuple, got.collect())) == best(rows, least, longest, per_lang, percent)


def test_small_slices_give_the_same(spark, run, monkeypatch):
    rows = corpus(60)
    monkeypatch.setattr(phrases, "WORDS", 50)     # reaches the workers with the functions' module state only if forked late,
    monkeypatch.setattr(phrases, "SLICE", 64)     # so the pieces are also tested in this process below
    values = np.arange(1, len(rows) + 1, dtype=np.uint64)
    texts = pa.array([t for t, _ in rows], pa.string())
    parts = list(phrases.words_of(texts, values))
    monkeypatch.setattr(phrases, "SLICE", 1 << 19)
    whole = list(phrases.words_of(texts, values))
    assert len(parts) > len(whole) == 1
    for name in ("hashes", "docs"):
        assert (np.concatenate([getattr(w, name) for w in parts]) == getattr(whole[0], name)).all()
    new = [np.diff(np.concatenate([w.pieces for w in ws])) != 0 for ws in (parts, whole)]
    assert (new[0] == new[1]).all()
    words = [w.data[a:a + n].tobytes().decode() for w in parts for a, n in zip(w.starts, w.sizes, strict=True)]
    assert words == [x for t, _ in rows for x in re.findall(r"[^\x20\x09.,;:!?\x0a-\x0d]+", (t or "").translate(LOWER))]


def test_windows_in_the_lead_are_counted_once():
    ids = np.array([1, 2, 3, 4, 5, 6, 0, 7, 8], np.uint32)
    for order in range(2, 6):
        whole = phrases._windows(ids, 0, order, None).tolist()
        halves = phrases._windows(ids[:5], 0, order, None).tolist()
        halves += [1 + k for k in phrases._windows(ids[1:], 4, order, None).tolist()]
        assert halves == whole


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 5), st.integers(1, 40), st.lists(st.integers(0, 2 ** 40), min_size=1, max_size=60), st.integers(0, 6))
def test_filters_lose_nothing(words, bits, numbers, shard_bits):
    layout = quotient.Layout(words, bits)
    ids = [np.array([(x >> k) % (1 << bits) for x in numbers], np.uint64) for k in range(words)]
    want = Counter(zip(*(x.tolist() for x in ids), strict=True))
    limbs = quotient.pack(ids, layout)
    assert all((a == b).all() for a, b in zip(quotient.unpack(limbs, layout), ids, strict=True))
    shard_bits = min(shard_bits, layout.widths[0])
    got = Counter()
    for shard in range(1 << shard_bits):
        filters = []
        for part in (slice(0, 20), slice(20, None)):
            keys, counts = quotient.counted([x[part] for x in limbs])
            own = (keys[0] >> np.uint64(layout.widths[0] - shard_bits)) == shard if shard_bits else np.ones(len(counts), bool)
            if own.any():
                blob = quotient.encode([x[own] for x in keys], counts[own] * 200, layout, shard_bits)
                filters.append(quotient.decode(blob, layout, shard_bits, shard))
        if filters:
            keys, counts = quotient.merge(filters)
            got.update(dict(zip(zip(*(x.tolist() for x in quotient.unpack(keys, layout)), strict=True),
                                (counts // 200).tolist(), strict=True)))
    assert got == want


def test_no_rows_and_no_frequent_words(spark, run):
    for rows in ([], [(None, None), ("one two", "en")]):
        out = phrases.collocations(run, frame(spark, rows))
        assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.count() == 0
