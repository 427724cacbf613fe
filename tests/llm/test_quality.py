"""The quality classifier: votes against a plain loop, held-out accuracy, edge cases."""

import zlib

import numpy as np
import pytest

from transcript_quality.llm import quality as Q
from transcript_quality.llm import queries

SF = "/root/testdata/sf0.01"


def plain_terms(t):
    out = np.zeros(Q.BUCKETS + Q.SHARES)
    w = t.split()
    if not w:
        return out
    for i in range(len(t) - 2):
        out[((t[i] << 16 | t[i + 1] << 8 | t[i + 2]) * 2654435761 & 0xFFFFFFFF) >> 21] += 1
    out[:Q.BUCKETS] /= max(1, len(t) - 2)
    k = len(set(w)) / len(w)
    out[Q.BUCKETS:] = k, 1 - k, sum(a == b for a, b in zip(w, w[1:])) / len(w), sum(x.isupper() for x in w) / len(w)
    return out


def test_votes_against_loop(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = Q.learn(docs, labels.where("doc_id % 5 > 0"))
    texts = [r.text.encode() for r in docs.orderBy("doc_id").take(60)] + [b"", None, b" \n"]
    got = model.score(texts)
    assert got[-3:].tolist() == [0, 0, 0]
    for t, s in zip(texts[:-3], got):
        x = plain_terms(t)
        assert Q.terms(t) == pytest.approx(x, abs=1e-6)
        z = (np.sqrt(x) * model.idf) @ model.v
        cos = model.z @ (z / np.linalg.norm(z))
        near = np.argsort(-cos)[:Q.NEIGHBOURS]
        w = np.maximum(cos[near], 1e-6) ** Q.SHARPNESS
        assert s == pytest.approx((w * model.y[near]).sum() / w.sum(), abs=0.1)


def test_held_out(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op2_quality_classifier(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    low = [r.score for r in held if not truth[r.doc_id]]
    assert np.mean([[a > b for b in low] for a in (r.score for r in held if truth[r.doc_id])]) > 0.98


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a good text", 9), (1, "a good text", 9), (2, None, 9), (3, "", 9), (4, "BAD BAD BAD", 9), (None, "a good one", 9), (5, "w " * 600000, 9)],
                                 "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(1, 1), (4, 0), (2, 0), (5, 0), (5, 1), (None, 1), (3, None)], "doc_id long, quality int")
    rows = Q.quality(docs, labels, folds=10**9, held=-5).collect()
    got = {r.doc_id: r.score for r in rows}
    assert len(rows) == 7 and got[2] == got[3] == 0 and got[1] > 0.5 > got[4] and got[None] > 0.5
    assert all(r.score == 0 for r in Q.quality(docs, labels.limit(0)).collect())
    assert Q.quality(docs.limit(0), labels).collect() == []


def test_labels_of_absent_texts_take_no_place(spark):
    docs = spark.createDataFrame([(i, "good text %d" % i if i % 2 else "BAD BAD %d" % i) for i in range(40)] + [(1000 + i, None) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1000 + i, i % 2) for i in range(600)], "doc_id long, quality int")
    assert sorted(Q.learn(docs, labels, per_class=20).y.tolist()) == [0] * 20 + [1] * 20
