import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import edit_distance, tokens
from transcript_quality.functions.text import (
    base_filename, sanitize_filename, strip_file_scheme, tokenize_words, wer, wer_parts, wer_with_policy,
)


def test_tokenization_rules(spark):
    df = spark.createDataFrame([("  a  b\n\nc d\ne ",), (None,), ("",), ("Hello, World!",)], "t string")
    got = [r.w for r in df.select(tokenize_words("t").alias("w")).collect()]
    assert got == [tokens("  a  b\n\nc d\ne "), [], [], ["Hello,", "World!"]]
    assert got[0] == ["a", "b", "c", "d\ne"]   # a single newline does not split


def test_wer_against_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(30)] + ["é", "naïve", "日本", "a:b"]
    rows = []
    for _ in range(200):
        r = " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 40)))
        h = " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40)))
        rows.append((r, h))
    df = spark.createDataFrame(rows, "r string, h string")
    out = df.select("r", "h", wer_parts("r", "h").alias("p"), wer("r", "h").alias("wer")).collect()
    for row in out:
        d = edit_distance(tokens(row.r), tokens(row.h))
        assert row.p.edits == d
        assert row.wer == pytest.approx(d / len(tokens(row.r)))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["x", "y", "z", "xy", "Z"]), min_size=0, max_size=12),
       st.lists(st.sampled_from(["x", "y", "z", "xy", "Z"]), min_size=0, max_size=12))
def test_wer_property(spark, r, h):
    df = spark.createDataFrame([(" ".join(r), " ".join(h))], "r string, h string")
    got = df.select(wer_parts("r", "h").alias("p")).first().p
    assert got.edits == edit_distance(r, h) and got.ref_words == len(r) and got.hyp_words == len(h)


def test_wer_policy(spark):
    df = spark.createDataFrame([("a b c", "a b c"), ("a b c", None), (None, "x"), ("", "x"), ("   ", "x"),
                                ("a b", "a c d e")], "r string, h string")
    got = [r.w for r in df.select(wer_with_policy("r", "h", -1.0, -1.0).alias("w")).collect()]
    assert got == [0.0, 1.0, -1.0, -1.0, -1.0, 1.5]          # WER may exceed 1
    gt = [r.w for r in df.select(wer_with_policy("r", "h", 1.0, 1.0).alias("w")).collect()]
    assert gt[4] == 1.0


def test_long_texts_whole(spark):
    rng = random.Random(1)
    words = [f"t{i}" for i in range(3000)]
    r = " ".join(rng.choice(words) for _ in range(1500))
    h = " ".join(rng.choice(words) for _ in range(1400))
    got = spark.createDataFrame([(r, h)], "r string, h string").select(wer_parts("r", "h").alias("p")).first().p
    assert got.ref_words == 1500 and got.edits == edit_distance(tokens(r), tokens(h))


def test_positional_coding_when_hash_collides(spark, monkeypatch):
    """Force every word onto one hash code: the positional coding over the shorter side's
    words (words only the longer side has share position 0) must give exact distances."""
    import transcript_quality.functions.text as T
    monkeypatch.setattr(T, "_hash_code", lambda w: F.lit(0x10001))
    rng = random.Random(3)
    shared = [f"s{i}" for i in range(8)]
    rows = []
    for _ in range(150):
        r = [rng.choice(shared + [f"r{i}" for i in range(6)]) for _ in range(rng.randint(0, 30))]
        h = [rng.choice(shared + [f"h{i}" for i in range(6)]) for _ in range(rng.randint(0, 30))]
        rows.append((" ".join(r), " ".join(h)))
    df = spark.createDataFrame(rows, "r string, h string")
    for row in df.select("r", "h", T.wer_parts("r", "h").alias("p")).collect():
        assert row.p.edits == edit_distance(tokens(row.r), tokens(row.h))


def test_path_functions(spark):
    df = spark.createDataFrame([("file:/data/in/a:b.wav",), ("/x/y/",)], "p string")
    out = df.select(base_filename(strip_file_scheme("p")).alias("f"),
                    sanitize_filename(base_filename("p")).alias("s")).collect()
    assert [(r.f, r.s) for r in out] == [("a:b.wav", "a-b.wav"), ("", "")]
