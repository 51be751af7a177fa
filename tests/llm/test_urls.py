"""URL filter: brute force over awkward urls, collisions of short keys, several files, empty tables."""

import random
import re

import numpy as np
import pytest

from claimflow.llm import digests, urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PAGES = "page_id long, url string, html string, host string, path string, rule string, verdict string, key string, ends string"


def judged(url, rules):
    parts = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (parts[1].translate(LOWER), parts[2]) if parts else ("", "")
    best = None
    for rule_host, rule_path, verdict in rules:
        h, p = rule_host.translate(LOWER), rule_path or ""
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len((h + p).encode()), len(h.encode()), verdict)
            best = max(best, (rank, h + p, verdict)) if best else (rank, h + p, verdict)
    return (host, path, best[1], best[2]) if best else (host, path, None, "allow")


def frame(spark, found):
    return spark.createDataFrame([(i, u, "h", "x", "y", "z", "v", "k", "e") for i, u in found], PAGES)


def some_urls():
    rng = random.Random(5)
    hosts = ["example.com", "www.Example.COM", "a.b.example.com", "notexample.com", "example.net", "x.net", "net", "com",
             "é.com", "com.", ".com", "a..com", "", "example.com:80", "deep." * 300 + "com", "org"]
    paths = ["", "/", "/en/", "/en", "/en/x", "/EN/", "/es/1", "/fr/é", "/fr", "/ent", "//en/", "/en/" + "y" * 5000]
    tails = ["", "?q=/en/", "#://other.com/en/", "?", "#"]
    found = [(k, f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}") for k in range(400)]
    found += [(500, None), (501, ""), (502, "example.com/en/"), (503, "://"), (504, "a://b://example.com/en/"), (None, None),
              (505, "HTTP://EXAMPLE.COM/en/\nmore"), (506, "http://hot.net/es/"), (506, "http://hot.net/es/")]
    return found + [(600 + k, "http://hot.net/es/x") for k in range(300)]


MORE = [*urls.RULES, ("Example.net", None, "block"), ("b.example.com", "/en/x", "allow"), ("é.com", "/fr/é", "block"),
        ("com", "/en", "block"), ("com", "/en", "allow"), ("com", "/en/" + "y" * 4000, "block"), ("x.net", "/es/1", "allow")]
BROKEN = [("", "/", "block"), (None, "/", "block"), ("com", "en", "block"), ("co/m", "/", "block"), ("com", "/e", "maybe"),
          ("com", "/e", None)]


@pytest.mark.parametrize(("rules", "bits"), [(urls.RULES, 64), (MORE, 64), (MORE, 3), (MORE, 1)])
def test_verdicts_equal_brute_force(spark, run, rules, bits):
    found = some_urls()
    table = spark.createDataFrame([*rules, *BROKEN], "host string, path string, verdict string")
    got = urls.Filter(run, table, bits=bits).judge(frame(spark, found)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(((i, *judged(u, rules)) for i, u in found), key=key)


def test_many_rules_in_several_files(spark, run):
    rules = [(f"h{k}.example.org", f"/{k % 7}/", "block") for k in range(3000)]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    entries = run.stage(table.selectExpr("xxhash64(concat(host, path)) key", "concat(host, path) text", "host payload"), "e")
    name = digests.publish(entries, "many", part_bytes=10_000)
    assert len(name.files) > 4

    def probe(batches):
        import pyarrow as pa
        held = digests.DigestArray(name)
        for b in batches:
            texts = [x.encode() for x in b.column(0).to_pylist()]
            sizes = np.array([len(x) for x in texts])
            keys = np.array([digests.digest(x) for x in texts], np.uint64)
            data = np.frombuffer(b"".join(texts), np.uint8)
            payload = [None] * len(texts)
            for hit, values in held.find(keys, data, np.cumsum(sizes) - sizes, sizes):
                for k, v in zip(hit, values, strict=True):
                    payload[k] = v.decode()
            numbers = held.numbers(keys)
            again = [held.entry(n)[0].decode() if n >= 0 else None for n in numbers.tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(payload, pa.string()), pa.array(again, pa.string())],
                                             ["text", "payload", "again"])

    asked = entries.select("text").unionByName(entries.selectExpr("concat(text, 'x') text"))
    rows = asked.mapInArrow(probe, "text string, payload string, again string").collect()
    assert len(rows) == 6000
    for r in rows:
        known = not r["text"].endswith("x")
        assert (r["payload"], r["again"]) == ((r["text"].partition("/")[0], r["text"]) if known else (None, None))


def test_no_rules_and_no_rows(spark, run):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    got = urls.Filter(run, rules).judge(frame(spark, some_urls()[:20])).collect()
    assert {(r["rule"], r["verdict"]) for r in got} == {(None, "allow")} and len(got) == 20
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    out = urls.Filter(run, rules).judge(frame(spark, []))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"] and out.count() == 0
