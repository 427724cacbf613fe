import json
import os

import pytest
from pyspark.sql import functions as F

from transcript_quality.operators import manifest as MF
from transcript_quality.schemas import MANIFEST
from transcript_quality.sinks.writers import write_manifest, write_reference_lookup
from transcript_quality.sources.tables import read_manifest, read_reference_lookup


def rows(ids):
    return [(i, f"/audio/{i}.wav", f"text {i}", "s", "f") for i in ids]


def test_merge_existing_first(spark):
    existing = spark.createDataFrame(rows(["b", "a"]), MANIFEST)
    new = spark.createDataFrame(rows(["c", "a", "d"]), MANIFEST)
    got = [r.audio_id for r in MF.merge_manifest(existing, new, max_samples=3).collect()]
    assert sorted(got) == ["a", "b", "c"]
    assert sorted(r.audio_id for r in MF.merge_manifest(existing, new).collect()) == ["a", "b", "c", "d"]


def test_first_rows_and_large_cap(spark):
    import random
    rng = random.Random(4)
    keys = [f"k{rng.randrange(10**6):06d}" for _ in range(4000)] + [None] * 5
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "audio_id string, i int").repartition(6)
    for n in (1, 7, 1500, 3999):
        got = sorted((r.audio_id or "") for r in MF.first_rows(df, "audio_id", n).collect())
        exp = sorted((r.audio_id or "") for r in df.orderBy("audio_id").limit(n).collect())
        assert got == exp
    hot = spark.createDataFrame([("k5", i) for i in range(300)] + [(f"k{i}", i) for i in range(10)], "audio_id string, i int")
    got = MF.first_rows(hot, "audio_id", 200).collect()
    assert len(got) == 200 and sorted(r.audio_id for r in got) == sorted(["k0", "k1", "k2", "k3", "k4"] + ["k5"] * 195)
    existing = spark.createDataFrame(rows([f"e{i:04d}" for i in range(300)]), MANIFEST)
    new = spark.createDataFrame(rows([f"n{i:04d}" for i in range(900)] + ["e0001"]), MANIFEST)
    for cap in (200, 1000):
        top = sorted([f"e{i:04d}" for i in range(300)]) + sorted(f"n{i:04d}" for i in range(900))
        assert sorted(r.audio_id for r in MF.merge_manifest(existing, new, max_samples=cap).collect()) == sorted(top[:cap])


def test_existing_audio_and_lookup(spark):
    m = spark.createDataFrame(rows(["x:1", "y", "z"]) + [("e", "/audio/e.wav", "", "s", "f")], MANIFEST)
    files = spark.createDataFrame([("file:/landing/x:1.wav",), ("file:/landing/z.wav",), ("file:/landing/e.wav",)], "path string")
    present = MF.existing_audio(m, files)
    assert sorted(r.audio_id for r in present.collect()) == ["e", "x:1", "z"]
    lk = {r.filename: r.reference_text for r in MF.reference_lookup(present).collect()}
    assert lk == {"x-1.wav": "text x:1", "z.wav": "text z"}


def test_sample_exact(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r.k for r in MF.sample_exact(df, "k", 51).collect()]
    b = [r.k for r in MF.sample_exact(df.repartition(5), "k", 51).collect()]
    assert len(a) == 51 and sorted(a) == sorted(b) and len(set(a)) == 51
    assert MF.sample_exact(df, "k", 5000).count() == 1000
    with pytest.raises(ValueError):
        MF.sample_exact(df, "k", 0)


def test_sample_exact_rank_filter_matches_top_k(spark):
    df = spark.range(3000).withColumnRenamed("id", "k").repartition(7)
    top = [r.k for r in df.orderBy(MF.sample_order("k"), "k").limit(700).collect()]
    ranked = sorted(r.k for r in MF.sample_exact(df, "k", 700).collect())
    assert len(ranked) == 700 and ranked == sorted(top)
    assert MF.sample_exact(df, "k", 5000).count() == 3000
    twice = df.union(df).union(df.where("k < 9"))
    assert MF.sample_exact(twice, "k", 1001).count() == 1001


def test_first_rows_hot_key_and_repeated_rows(spark):
    hot = spark.range(6000).selectExpr("CASE WHEN id < 2999 THEN 'm' WHEN id < 4500 THEN concat('a', id) ELSE concat('z', id) END AS k", "id % 50 AS v")
    for n in (1500, 1501, 1502, 4499, 4500, 4501):
        got = MF.first_rows(hot, "k", n).collect()
        assert len(got) == n and sum(r.k == "m" for r in got) == min(2999, max(0, n - 1501))
    assert MF.first_rows(hot, "k", 9000).count() == 6000


def test_lookup_json_roundtrip_and_missing(spark, tmp):
    lk = spark.createDataFrame([("a.wav", "hello there"), ("b.wav", "")], "filename string, reference_text string")
    p = os.path.join(tmp, "lookup.json")
    write_reference_lookup(lk, p, as_json=True)
    back = {r.filename: r.reference_text for r in read_reference_lookup(spark, p).collect()}
    assert back == {"a.wav": "hello there"}
    single = os.path.join(tmp, "single.json")
    json.dump({"x.wav": "one", "y.wav": "two"}, open(single, "w"), indent=2)
    assert read_reference_lookup(spark, single).count() == 2
    assert read_reference_lookup(spark, os.path.join(tmp, "nope.json")).count() == 0


def test_manifest_csv_roundtrip(spark, tmp):
    df = spark.createDataFrame(rows(["a", "b"]) + [("c", "/audio/c.wav", 'he said "hi", then\nleft', "s", "m")], MANIFEST)
    p = os.path.join(tmp, "manifest")
    write_manifest(df, p)
    back = read_manifest(spark, p)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(FileNotFoundError):
        read_manifest(spark, os.path.join(tmp, "missing.csv"))
