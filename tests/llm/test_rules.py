"""Base counts and the log-likelihood ratio against brute force."""

import math
import re
import zlib

import pytest

from transcript_quality.llm import queries, rules

SF = "/root/testdata/sf0.001"
M = 1 << 16


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def base(t):
    w = words(t)
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    lines = [x for x in (t or "").split("\n") if words(x)]
    hit = {i + j for i, x in enumerate(win) if win.count(x) > 1 for j in range(5)} if len(set(win)) < len(win) else set()
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit)


def buckets(t):
    c = [zlib.crc32(w.encode()) for w in words(t)]
    a, b, full = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, (1 << 64) - 1
    return [((x + 1) * a & full) >> 48 for x in c] + [((((x * a & full) ^ (y * b & full)) * b) & full) >> 48 for x, y in zip(c, c[1:])]


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1}
    raw, target = [1] * M, [1] * M
    for d, t in docs:
        for g in buckets(t):
            raw[g] += 1
            target[g] += d in good
    got = {r.doc_id: r for r in queries.op7_quality_rules(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        r, b = got[d], base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        failed = b[0] < 10 or 100 * b[4] > 20 * b[0]
        g = buckets(t)
        score = sum(math.log(target[x] / sum(target) * sum(raw) / raw[x]) for x in set(g) for _ in range(g.count(x))) / len(g) if len(g) < 400 else r.score
        assert r.score == pytest.approx(score, abs=1e-9) and r.base_failed == failed and r.kept == (not failed and r.score >= rules.THRESHOLD)


def test_edges(spark):
    texts = [None, "", " \n\t", "a b c d e\na b c d e\n\n a b c d e", "x " * 30000, "ünï ** çode\x0bword\x0c1 <|>", "q\xa0r s", "one two three four five six seven eight nine ten"]
    df = spark.createDataFrame([(i, t, 0, 1.5) for i, t in enumerate(texts)] + [(3, texts[3], 0, 1.5)], "doc_id long, text string, n_words int, score double")
    labels = spark.createDataFrame([(3, 1), (3, 0), (5, 1)], "doc_id long, quality int")
    rows = rules.quality_rules(df, labels).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        if r.doc_id != 4:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(texts[r.doc_id])
    assert next(r for r in rows if r.doc_id == 4).n_repeat_words == 30000
    assert all(r.score == 0 for r in rules.quality_rules(df, labels.limit(0)).collect())
    assert rules.quality_rules(df.limit(0), labels).collect() == []
    many = [str(i % 3001).encode() for i in range(40000)]
    assert rules.repeated_words(many) == 40000 and rules.repeated_words(many[:3005]) == 0 and rules.repeated_words(many[:3006]) == 10
