"""Ranked search against plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from transcript_quality.llm import signatures as S


def terms(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    own = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    total, length = len(own), sum(c.total() for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, c in own:
            m = 100 - 25 + (25 * c.total() * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                rows.append((-s, S.LAST if d is None else d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(rows)[:20], 1)]
    return sorted(out)


def result(df):
    return sorted((r.item_id, r["rank"], S.LAST if r.doc_id is None else r.doc_id, r.score) for r in df.collect())


@pytest.mark.parametrize("round_bytes", [4 << 20, 300])
def test_made(spark, monkeypatch, round_bytes):
    monkeypatch.setattr(S, "ROUND", round_bytes)
    rng = random.Random(2)
    vocabulary = ["w%d" % int(rng.paretovariate(0.7)) for _ in range(400)] + ["Äpfel", "ÄPFEL", "x_y", "日本", "Z"]
    docs = [(d, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 40, 300])))) for d in range(300)]
    docs += [(17, docs[40][1]), (None, docs[41][1]), (400, None), (401, " ,. "), (402, "w1 " * 5000), (403, "W1")]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))) for i in range(25)] + [(90, "nowhere found"), (91, "w1"), (92, "w1 W1 w1 z"), (93, None)]
    df = spark.createDataFrame([(d, t, 1, "r") for d, t in docs], "doc_id long, text string, score int, term string").repartition(5)
    q = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, doc_id int")
    got = result(S.search(df, q.union(q.limit(3))))
    assert got == brute(docs, items)


def test_bounds_never_below_the_score():
    rng = random.Random(4)
    docs = [(d, Counter(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(1, 60)))) for d in range(100)]
    held = [(d, c.total(), c) for d, c in docs]
    total, length = len(held), sum(n for _, n, _ in held)
    row = S._block([(d, n, np.asarray([S.hash_of(t) for t in c], np.uint64), np.asarray(list(c.values()))) for d, n, c in held])
    names = sorted({t for _, c in docs for t in c})
    queries = [(t, [(t, 7, [[int(k[0]) for k in S.keys_of(np.asarray([S.hash_of(t)], np.uint64), j)] for j in range(len(S.LEVELS) + 1)])]) for t in names]
    exact = 0
    for t, ids, bound in S._bounds(row, queries, total, length):
        for (d, n, c), b in zip(held, bound.tolist()):
            s = 7 * S.share(c[t], 75 + 25 * n * total // length) if c[t] else 0
            assert b >= s
            exact += b == s
    assert exact > 0.8 * len(names) * len(docs)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert S.search(docs, items).collect() == []
    assert S.search(items.select("item_id", "text").withColumnRenamed("item_id", "doc_id"), items.limit(0)).collect() == []
