"""Small tables with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              # names that the operators use themselves
              "digest string, size string, key string, n string, score string, copies string, at string")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(n))


def awkward_docs(n=120, seed=7):
    """(doc_id, text, source): copies, near copies, nulls, empty, very long, repeated rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((i, sentence(rng, rng.choice([1, 2, 3, 30, 60, 200])), rng.choice(["b", "a", None, "é", "hot", "hot"])))
    for i in range(30):  # near copies of one text: one word replaced
        words = rows[5][1].split(" ") * 3 if i == 0 else base
        base = words if i else (rows[5][1] + " " + sentence(rng, 150)).split(" ")
        copy = list(base)
        copy[rng.randrange(len(copy))] = f"w{i}"
        rows.append((n + i, " ".join(copy), "hot"))
    rows += [(n + 50 + i, rows[8][1].replace(" ", "  \t"), "a") for i in range(20)]       # copies but for spaces
    rows += [(n + 80, None, "a"), (n + 81, "", None), (n + 82, " \n\t ", "b"), (n + 83, "x " * 60_000, "hot"),
             (n + 84, "y" * 1_500_000, "b"), (n + 85, "A b C", "a"), (n + 86, "a B c", "a")]
    rows += [rows[3], rows[3], (3, "another text of the same id", "b"), (None, rows[8][1], "a"), (None, None, None)]
    return rows


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "d", "s", "k", "n", "c", "7", "z") for i, t, s in rows],
                                 DOC_SCHEMA)


def shingle_set(text, size):
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size)), strict=False))


def near_components(rows, size, percent):
    """doc_id -> smallest reachable doc_id, by comparing all pairs."""
    parent = {i: i for i, _, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t, size)) for i, t, _ in rows if i is not None]
    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(k)
    common = Counter((a, b) for ks in where.values() for b in ks for a in ks if a < b)
    for (a, b), both in common.items():
        if 100 * both >= percent * (len(sets[a][1]) + len(sets[b][1]) - both):
            x, y = root(sets[a][0]), root(sets[b][0])
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def backoff_scores(texts, order):
    """Per text (words, hits by order from 2, score): counts of the other texts, order by order."""
    texts = [WORDS.findall(t or "") for t in texts]

    def counted(words):
        return Counter(tuple(words[k:k + n]) for n in range(1, order + 1) for k in range(len(words) - n + 1))

    every = sum(map(counted, texts), Counter())
    total = sum(map(len, texts))

    def log(x):
        return round(math.log(max(x, 1)) * 1e6)

    for words in texts:
        own, score, hits = counted(words), 0, [0] * (order - 1)
        for k in range(len(words)):
            most = min(order, k + 1)
            for n in range(most, 0, -1):
                gram = tuple(words[k - n + 1:k + 1])
                seen = every[gram] - own[gram]
                if n == 1:
                    score += log(seen) - log(total - len(words)) + (most - 1) * log_backoff()
                elif seen:
                    score += log(seen) - log(every[gram[:-1]] - own[gram[:-1]]) + (most - n) * log_backoff()
                    hits[n - 2] += 1
                    break
        yield len(words), tuple(hits), score


def log_backoff():
    return round(math.log(0.4) * 1e6)
