"""Archives, lines, vectors and conversations; empty tables of every query."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import edit_distance, sentence
from pyspark.sql import functions as F

from claimflow.llm import ann, components, lines, prefs, queries, warc

PAGES = "page_id long, url string, html string, bytes string, digest string, value string"


def test_archives_round_trip(spark, run):
    hot = "<p>" + "same " * 60
    rows = [(10 + k, f"http://h/{k}", hot) for k in range(40)]
    rows += [(5, "http://first\r\nEvil: 1/é", hot), (1, None, None), (2, "u", ""), (3, "u", "short"), (4, "u", "short"),
             (60, "u", "WARC/1.1\r\n\r\n" * 40), (61, "v", "WARC/1.1\r\n\r\n" * 40), (62, "w", "ü" * 50),
             (63, "w", "ü" * 50), (None, "x", hot), (None, "x", "y" * 200), (70, "z", "z" * 300), (70, "z", "z" * 300),
             (80, "long", "é\r\n" * 400_000)]
    pages = spark.createDataFrame([(*r, "b", "d", "v") for r in rows], PAGES)
    path = run.path("warc")
    warc.write_archives(run, pages, path)
    records = warc.resolved(run, warc.read_archives(spark, path, with_payload=True)).collect()
    assert len(records) == len(rows)
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        named = [p for p in groups[html or ""] if p is not None]
        again = len(data) >= 100 and named and page != min(named)
        want[page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response",
             min(named) if again else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in records) == want
    for r in records:
        if r["record_type"] == "response":
            assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] == r["stored_digest"]
        else:
            assert r["payload"] is None


def test_broken_archive_is_an_error():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort\r\n\r\n"))


def test_components_of_paths_and_stars(run, spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(200, 260)] + [(7, k) for k in range(300, 400)] + [(500, 500), (None, 3), (401, 300)]
    links += [(rng.randint(600, 700), rng.randint(600, 700)) for _ in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components.components(
        run, spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}


def test_banded_distance_against_the_full_table(spark):
    rng = random.Random(1)
    rows = [("", ""), ("", "ab"), ("abc", ""), ("a", "a")]
    for _ in range(800):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 10)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, len(b))
            b[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "é"])
        rows.append((a, "".join(b)))
    pairs = spark.createDataFrame(rows, "a string, b string")
    for edits in (1, 2, 3):
        got = pairs.select("a", "b", lines.within(F.col("a"), F.col("b"), edits).alias("w")).collect()
        assert all(r["w"] == (edit_distance(r["a"], r["b"]) <= edits) for r in got)


def test_near_lines_against_all_pairs(spark, run):
    rng = random.Random(5)
    base = [sentence(rng, 8) for _ in range(12)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(4):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                k = rng.randrange(len(line))
                line[k:k + rng.randint(0, 1)] = rng.choice(["", "z", "é"])
            text.append("".join(line))
        rows.append((i, "\n".join([*text, "", "short", "shorx"])))
    rows += [(60, None), (61, ""), (62, "\n\n"), (None, base[0]), rows[0]]
    docs = spark.createDataFrame([(*r, "i", "k") for r in rows], "doc_id long, text string, id string, line string")
    first, copies = {}, Counter()
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, line in enumerate((t or "").split("\n")):
            if line:
                copies[line] += 1
                first.setdefault(line, (i is None, i, k))
    near = defaultdict(set)
    names = [x for x in first if len(x) >= lines.SHORTEST]
    for a in names:
        for b in names:
            if a < b and abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2:
                near[a].add(b)
                near[b].add(a)
    want = {}
    for line in first:
        seen, todo = {line}, [line]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        rep = min((first[x] for x in seen), key=lambda p: (p[0], p[1] or 0, p[2]))
        want[first[line][1:]] = (copies[line], len(near[line]), rep[1:], rep == first[line])
    got = {(r["doc_id"], r["line_no"]): (r["copies"], r["links"], (r["class_doc_id"], r["class_line_no"]), r["kept"])
           for r in lines.near_lines(run, docs).collect()}
    assert got == want
    assert sum(x[1] for x in want.values()) > 50


def test_search_is_exact_on_one_list_and_handles_odd_vectors(spark, run):
    rng = np.random.default_rng(8)
    rows = [(k, rng.standard_normal(6).round(1).tolist()) for k in range(150)]
    rows += [(200 + k, rows[20][1]) for k in range(30)]
    rows += [(300, None), (400, [0.0] * 6), (500, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] * 6),
             (700, [float("inf")] + [1.0] * 5), (800, [1.0, 2.0]), (None, rows[1][1]), rows[100], rows[100]]
    table = spark.createDataFrame([(*r, "q", "l") for r in rows], "vec_id long, embedding array<float>, query string, list string")
    got = defaultdict(list)
    for r in ann.search(run, table, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    valid = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and i < 300}
    assert set(got) == {i for i in valid if i % 20 == 0}
    for q, found in got.items():
        want = sorted((float(np.sqrt(((v - valid[q]) ** 2).sum())), i) for i, v in valid.items() if i != q)[:10]
        assert [(r, i) for r, i, _ in sorted(found)] == [(k + 1, i) for k, (_, i) in enumerate(want)]
        assert np.allclose([s for _, _, s in sorted(found)], [s for s, _ in want])


def test_scan_gives_up_early_but_finds_the_nearest():
    rng = np.random.default_rng(9)
    data = rng.standard_normal((4000, 64))
    turned = data @ ann.rotation(64)
    blocks = [turned[:, c:c + 16] for c in range(0, 64, 16)]
    hit = 0
    for q in rng.standard_normal((20, 64)):
        found, score = ann.scan(q, q @ ann.rotation(64), data, blocks, np.arange(4000), 10)
        exact = np.sqrt(((data - q) ** 2).sum(1))
        assert np.allclose(score, exact[found])
        hit += len(set(found) & set(np.argsort(exact)[:10]))
    assert hit >= 190


def test_preference_pairs(spark):
    talk = "array<struct<role:string,text:string>>"
    rows = [(1, [("user", "hi"), ("assistant", "a")], [("user", "hi"), ("assistant", "b"), ("user", "c")]),
            (2, [("user", "é")], [("user", "é"), ("assistant", None)]), (3, None, []), (4, [("user", "x")], [("user", "x")])]
    pairs = spark.createDataFrame([(*r, "old", "c", "r", "z", "s") for r in rows],
                                  f"id int, chosen {talk}, rejected {talk}, prompt string, _c string, _r string, c0 string, `a.b` string")
    got = {r["id"]: r for r in prefs.format_pairs(pairs).collect()}
    assert {(r["_c"], r["_r"], r["c0"], r["a.b"]) for r in got.values()} == {("c", "r", "z", "s")}
    a = got[1]
    assert (a["prompt_turns"], a["prompt"]) == (1, "<|im_start|>user\nhi<|im_end|>\n")
    assert a["chosen_completion"] == "<|im_start|>assistant\na<|im_end|>\n"
    for side in ("chosen", "rejected"):
        text = a[f"{side}_completion"]
        assert [text[s["start"]:s["end"]] for s in a[f"{side}_spans"]] == [{"chosen": "a", "rejected": "b"}[side] + "<|im_end|>"]
    assert got[2]["chosen_completion"] == "" and got[2]["rejected_completion"] == "<|im_start|>assistant\n<|im_end|>\n"
    assert got[3]["prompt_turns"] == 0 and got[3]["prompt"] == "" and got[4]["prompt_turns"] == 1
    assert got[4]["chosen_spans"] == [] and got[4]["rejected_completion"] == ""


def test_conversations_are_ordered_and_null_ids_left_out(spark):
    rows = [(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, None, "user", "z"), (None, 0, "user", "n"),
            (1, 1, "assistant", None), (1, 1, "assistant", None)]
    talk = prefs.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    [row] = talk.collect()
    assert [t["text"] for t in row["turns"]] == ["z", "a", "", "", "c"]
    [pair] = prefs.reply_pairs(talk).collect()
    assert [t["text"] for t in pair["rejected"]] == ["z", "a", "", "", ""]


def test_every_conversation_gives_a_pair(spark):
    rows = [(1, k, r, t) for k, (r, t) in enumerate([("user", "q"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2"), ("user", "bye")])]
    rows += [(2, 0, "user", "q"), (2, 1, "assistant", "only"), (2, 2, "user", "end"), (3, 0, "user", "alone"),
             (4, 0, "assistant", "same"), (4, 1, "assistant", "same")]
    talks = prefs.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in prefs.format_pairs(prefs.reply_pairs(talks)).collect()}
    assert {k: r["prompt_turns"] for k, r in got.items()} == {1: 3, 2: 1, 3: 1, 4: 2}
    one = got[1]       # 5 turns, 2 replies: the second is replaced by the first, and the turn after it stays
    assert one["chosen_completion"] == "<|im_start|>assistant\na2<|im_end|>\n<|im_start|>user\nbye<|im_end|>\n"
    assert one["rejected_completion"] == "<|im_start|>assistant\na1<|im_end|>\n<|im_start|>user\nbye<|im_end|>\n"
    assert got[2]["rejected_completion"].startswith("<|im_start|>assistant\n<|im_end|>\n<|im_start|>user\nend")
    assert got[3]["chosen_completion"] == got[3]["rejected_completion"] == got[4]["chosen_completion"] == ""


EMPTY = {"documents": "doc_id long, text string, lang string, source string, n_chars long",
         "labels": "doc_id long, quality int, toxic int", "pages": "page_id long, url string, html string",
         "embeddings": "vec_id long, embedding array<float>, label int",
         "conversations": "conv_id long, turn long, role string, text string"}


@pytest.mark.parametrize("name", [*sorted(queries.QUERIES), "pipeline"])
def test_empty_tables_give_no_rows(spark, tmp_path, name):
    for table, ddl in EMPTY.items():
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{table}.parquet")
    if name == "pipeline":
        import corpus_pipeline
        assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    else:
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for table in EMPTY:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = db.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    rows = Counter(json.dumps(r) for r in want.fetchall())
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(json.dumps(list(r)) for r in got.select(*columns).collect()) == rows


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    packed = out.groupBy("doc_id").count().count()
    assert 0 < packed < docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier"
