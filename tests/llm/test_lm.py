"""Language-model scores: base against plain counts, model against a step-by-step loop, gradients, edge cases."""

import collections
import math
import re
import zlib

import numpy as np
import pytest

from transcript_quality.llm import gru, lm, queries

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def base(docs):
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    c = collections.Counter()
    for d, t in docs:
        if not held[d]:
            c.update(words(t))
            c["\n"] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in docs:
        w = [*words(t), "\n"]
        out.append((d, held[d], len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    return out


def check(rows, docs):
    got = sorted((tuple(r)[:6] for r in rows), key=str)
    want = sorted(base(docs), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows)


def test_query_against_counts(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(queries.op10_lm_score(spark, SF).collect(), docs)


def test_rare_words_by_join(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 20)
    docs = [(i, " ".join(f"w{(i * 7 + j * j) % 40}" for j in range(i % 9))) for i in range(60)]
    check(lm.score(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "Same Row"), (3, "Same Row"), (None, "ünï \x00 same"), (5, "x " * 30000), (6, " \n")]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, word int")
    rows = lm.score(df).collect()
    check(rows, docs)
    assert lm.score(df.limit(0)).collect() == []
    alone = lm.score(df.where("doc_id = 3"), folds=1, held=0).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in alone] == [(0, 0, 0.0)] * 2


def small(seed=0):
    size = gru.Gru(None, 4, 3, 5).theta.size
    net = gru.Gru(np.random.default_rng(seed).standard_normal(size) * 0.5, 4, 3, 5)
    net.theta = net.theta.astype(np.float64)
    net.x, net.u, net.wc, net.bc, net.ww, net.bw = net._views(net.theta)
    return net


def test_gradient():
    net, rng = small(), np.random.default_rng(1)
    x, y = rng.integers(0, 15, (6, 4)), rng.integers(0, 15, (6, 4))
    y[5, 3] = -1
    start = rng.standard_normal((4, 4))
    grad = net.gradient(x, y, start)[2]
    for i in rng.choice(net.theta.size, 80, replace=False):
        two = []
        for e in (1e-3, -1e-3):
            net.theta[i] += e
            two.append(net.gradient(x, y, start)[0])
            net.theta[i] -= e
        assert grad[i] == pytest.approx((two[0] - two[1]) / 2e-3, abs=2e-3)


def test_state_is_carried():
    net, rng = small(2), np.random.default_rng(4)
    texts = [np.append(rng.integers(1, 15, n), 0) for n in (0, 3, 31, 32, 33, 200, 3)]
    for t, got in zip(texts, net.score(texts)):
        h, prev, want = np.zeros(4), 0, 0.0
        for k in t.tolist():
            gx, gh = net.x[prev], h @ net.u
            z, r = (1 / (1 + np.exp(-(gx[a:a + 4] + gh[a:a + 4]))) for a in (0, 4))
            n = np.tanh(gx[8:] + r * gh[8:])
            h, prev = n + z * (h - n), k
            lc, lw = h @ net.wc + net.bc, h @ net.ww[k // 5] + net.bw[k // 5]
            want += lc[k // 5] - np.log(np.exp(lc).sum()) + lw[k % 5] - np.log(np.exp(lw).sum())
        assert got == pytest.approx(want, abs=1e-4)


def test_learns():
    texts = [np.append(np.arange(2, 12), 0) for _ in range(400)]
    net = gru.Gru()
    before = net.score(texts[:1])[0]
    adam = gru.Adam(net, 0.01)
    for _ in range(80):
        adam.learn(texts)
    assert net.score(texts[:1])[0] > before / 5


def test_every_token_trains(spark):
    texts = [" ".join(f"w{(i + j) % 9}" for j in range(n)) for i, n in enumerate((0, 3, 191, 192, 1000, 20_000))]
    train = spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "t binary")
    rows = lm._replica(train, {b"w1": 2}, gru.Gru().theta, 1).where("block = 0")
    assert sum(r.tokens for r in rows.collect()) == sum(len(t.split()) + 1 for t in texts)
