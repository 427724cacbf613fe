"""Repeated passages against brute force over all windows; suffix arrays against sorted suffixes."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from transcript_quality.llm import queries, repeats
from transcript_quality.llm.suffixes import permuted_common_prefixes, suffix_array

SF = "/root/testdata/sf0.001"
W = 50


def brute(docs):
    """docs: (id, text bytes) -> sorted (id, n_bytes, n_removed, n_spans, sha256)."""
    first = {}
    for d, t in docs:
        for i in range(len(t) - W + 1):
            w = t[i:i + W]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - W + 1):
            if first[t[i:i + W]] < d:
                gone[i:i + W] = b"\1" * W
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((repeats.LAST if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(400):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 26, 256])
        b = bytes(rng.randrange(k) for _ in range(n)) * rng.choice([1, 3])
        t = np.frombuffer(b, np.uint8)
        sa = suffix_array(t)
        assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        far = permuted_common_prefixes(t, sa, W) if len(b) else []
        for x, y in zip(sa[:-1], sa[1:]):
            p, q = b[x:], b[y:]
            assert far[y] == next((i for i in range(W) if p[i:i + 1] != q[i:i + 1] or i >= len(p)), W)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(queries.op11_suffix_dedup(spark, SF)) == brute(docs)


def made(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("ab é") for _ in range(n))
    shared = [text(n) for n in (49, 50, 51, 90, 200)] + ["x" * 400, "the same words " * 30]
    docs = []
    for d in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.4 else text(rng.randint(0, 120)) for _ in range(rng.randint(0, 6))]
        t = "".join(parts)
        if t and rng.random() < 0.3:  # a near copy: one letter differs
            i = rng.randrange(len(t))
            t = t[:i] + "#" + t[i + 1:]
        docs.append((d, t))
    return docs + [(7, docs[8][1]), (7, docs[9][1]), (9, docs[9][1]), (None, docs[3][1] + shared[4]), (None, shared[4]), (100, None), (101, "")]


def local(rows, sizes, monkeypatch):
    """The operator's steps in this process, with small pieces, slices and sorts."""
    for name, value in sizes.items():
        monkeypatch.setattr(repeats, name, value)
    rows = [(repeats.LAST if d is None else d, (t or "").encode()) for d, t in rows]
    shards, spans = {}, {}
    for lo, hi in repeats.slices([len(t) for _, t in rows], repeats.SLICE):
        part = rows[lo:hi]
        packed, inner = repeats._send([t for _, t in part], np.asarray([d for d, _ in part]), np.asarray([hash(t) for _, t in part]), 5)
        for s, *row in packed:
            shards.setdefault(s, []).append(row)
        for d, k, s, n in zip(*inner):
            spans.setdefault((d, k), []).append((s, n))
    for packed in shards.values():
        for d, k, s, n in zip(*(repeats._judge(packed) or ((),) * 4)):
            spans.setdefault((d, k), []).append((s, n))
    out = []
    for d, t in rows:
        gone, runs, kept = repeats._cut(t, *np.asarray(spans.get((d, hash(t)), np.zeros((0, 2))), np.int64).T)
        out.append((d, len(t), gone, runs, hashlib.sha256(kept).hexdigest()))
    return rows, sorted(out)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("sizes", [{}, {"PIECE": 300, "SLICE": 900, "SORTED": 500}, {"PIECE": 70, "SLICE": 1, "SORTED": 10}])
def test_steps_against_brute_force(monkeypatch, seed, sizes):
    rows, got = local(made(seed), sizes, monkeypatch)
    assert got == brute(rows)


def test_made_documents(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD", 2000)
    rows = made(9)
    want = brute([(repeats.LAST if d is None else d, (t or "").encode()) for d, t in rows])
    df = spark.createDataFrame([(d, t, 5, "k") for d, t in rows], "doc_id long, text string, n long, key string")
    assert result(repeats.digest(repeats.cut_repeats(df))) == want
    assert result(repeats.digest(repeats.cut_repeats(df.repartition(7)))) == want


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.cut_repeats(none).collect() == []
    short = spark.createDataFrame([(1, "a" * 49), (2, "a" * 49), (3, None)], "doc_id long, text string")
    assert [r.n_removed for r in repeats.cut_repeats(short).collect()] == [0, 0, 0]


def test_split_hash_equals_one_sort(monkeypatch):
    rng = random.Random(3)
    base = bytes(rng.randrange(4) for _ in range(300))
    texts = [base[a:a + rng.randint(W, 120)] for a in (rng.randrange(180) for _ in range(200))]
    ids = np.asarray([rng.randrange(20) for _ in texts])
    want = repeats.later_windows(texts, ids)
    monkeypatch.setattr(repeats, "SORTED", 800)
    assert all((a == b).all() for a, b in zip(repeats._split(texts, ids), want, strict=True))


def test_regions_without_a_common_window_are_not_sorted(monkeypatch):
    """Regions that meet by their gram alone are not sorted; the repeats are those of all regions sorted."""
    rng = np.random.default_rng(6)
    some = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    gram, passage = some(16), some(70)
    plain = [some(60) + gram + some(60) for _ in range(200)]
    texts = [*plain, some(30) + passage + some(30), some(20) + passage[:55] + some(40), some(20) + passage[10:62], b"ab" * 80, b"x" + b"ab" * 70]
    ids, keys, sorted_texts = np.arange(len(texts)), np.arange(len(texts)), []
    packed, _ = repeats._send(texts, ids, keys, 1)
    later = repeats.later_windows
    monkeypatch.setattr(repeats, "later_windows", lambda t, i: sorted_texts.extend(t) or later(t, i))
    got = repeats._judge([x[1:] for x in packed])
    assert 0 < len(sorted_texts) < 60 and sum(gram in t for t in sorted_texts) < 10
    monkeypatch.setattr(repeats, "_may_share", lambda t: np.ones(len(t), bool))
    whole = repeats._judge([x[1:] for x in packed])
    assert all(a.tolist() == b.tolist() for a, b in zip(got, whole, strict=True)) and {201, 202, 204} <= set(got[0].tolist())


def test_many_shards_travel_in_few_batches(spark, monkeypatch):
    """A slice has a row for each shard; they go through Arrow together and not one by one, and give the same repeats."""
    rng = np.random.default_rng(7)
    words = ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(300)]
    text = [" ".join(rng.choice(words, 60)) for _ in range(120)]
    rows = [(i, i, (t + " " + text[i // 2][:200]).encode()) for i, t in enumerate(text)]
    docs = spark.createDataFrame(rows, "id long, key long, t binary").coalesce(1)
    few = sorted(map(tuple, repeats.repeated_windows(docs).collect()))
    monkeypatch.setattr(repeats, "SHARD", 1 << 9)
    frame, runs = type(docs), []

    def watched(self, fn, schema, *a, **k):
        runs.append(fn)
        return many(self, fn, schema, *a, **k)
    many = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", watched)
    assert sorted(map(tuple, repeats.repeated_windows(docs).collect())) == few and few
    batch = pa.record_batch({"id": [r[0] for r in rows], "key": [r[1] for r in rows], "t": pa.array([r[2] for r in rows], pa.binary())})
    sent = list(runs[0](iter([batch])))
    assert sum(b.num_rows for b in sent) > 100 > 5 > len(sent)
