"""SimHash near-duplicates against brute force."""

import numpy as np
import xxhash

from transcript_quality.llm import queries, simhash
from transcript_quality.llm.components import bit_links, components

SF = "/root/testdata/sf0.001"


def brute_fp(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    n = max(1, len(words) - 3)
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def brute_groups(rows):
    """rows: (id, fp) -> smallest reachable id for each row."""
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= 4:
                up[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return {(d, f): least.get(find(f)) for d, f in rows}


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in queries.op3_simhash_near_dup(spark, SF).collect()}
    assert got == brute_groups([(d, brute_fp(t)) for d, t in docs])


def test_planted_bits(spark):
    rng = np.random.default_rng(5)
    fps = [int(x) for x in rng.integers(-2**63, 2**63, 300)]
    for f in fps[:150]:
        flip = 0
        for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
            flip |= 1 << int(b)
        fps.append(int(np.uint64((f & (2**64 - 1)) ^ flip).astype(np.int64)))
    centre = fps[0] & (2**64 - 1)  # a dense group: everything within two bits of one point
    fps += [int(np.uint64(centre ^ (1 << a) ^ (1 << b)).astype(np.int64)) for a in range(64) for b in range(a)]
    fps = sorted(set(fps))
    got = {r.fp: r.root for r in simhash.link_fingerprints(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()}
    want = brute_groups([(f, f & (2**64 - 1)) for f in fps])
    assert {f: got.get(f, f) for f in fps} == {f: r for (f, _), r in want.items()}


def test_anchors_within_reach():
    fps = np.random.default_rng(1).integers(-2**63, 2**63, 50)
    row, key = simhash.anchors(fps)
    assert len(set(zip(row.tolist(), key.tolist()))) == len(row)
    for p, (first, length) in enumerate(simhash.PARTS):
        part = (fps.view(np.uint64) >> np.uint64(first)).astype(np.int64) & ((1 << length) - 1)
        here = key >> 32 == p
        word = key[here] & ((1 << 32) - 1)
        assert (np.bitwise_count(word ^ part[row[here]]) <= simhash.RADIUS + simhash.PART_BITS).all()
        near = {(r, w) for r, w in zip(row[here].tolist(), word.tolist()) if int(np.bitwise_count(np.int64(w ^ int(part[r])))) <= 1}
        assert {r for r, _ in near} == set(range(len(fps)))  # covering radius 1


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, "one two", "y"), (4, "one two", "y"), (None, "ONE two", "y"), (9, "z " * 30000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert [g[1] for g in got] == [1, 2, 3, 4, 4, 9, None]
    assert [g[3] for g in got] == [1, 1, 1, 4, 4, 9, 4]
    assert got[0][2] == "0" * 16
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 9]
    assert simhash.near_duplicates(df.limit(0)).collect() == []
    assert simhash.keep_one(df.limit(0)).collect() == []


def test_components_chain(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (101, 101)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).collect() == []


def test_large_keys_are_split(spark):
    """Keys over the cap give the same groups as small ones."""
    rng = np.random.default_rng(9)
    values = sorted({int(x) for x in rng.integers(0, 2**20, 900)})
    rows = spark.createDataFrame([(k, v) for k in (1, 2, 7) for v in (values if k != 2 else values[:30])], "key long, v long")
    want = brute_groups([(v, v) for v in values])
    for cap in (40, 300, 4096):
        got = {r.node: r.root for r in components(bit_links(rows, 4, cap)).collect()}
        assert {v: got.get(v, v) for v in values} == {v: r for (v, _), r in want.items()}
