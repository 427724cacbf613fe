import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import edit_distance as plain
from transcript_quality.functions import wer, wer_parts, word_edit_distance
from transcript_quality.functions import text as T
from transcript_quality.functions.edits import edit_distance

words = st.lists(st.sampled_from(["a", "b", "c", "ab", "é"]), max_size=80)


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_equals_plain_distance(a, b):
    assert edit_distance(a, b) == plain(a, b)


def test_frequent_words_and_no_common_word():
    rng = random.Random(1)
    a, b = ([rng.choice("the of to and x y z".split()) for _ in range(n)] for n in (700, 600))
    assert edit_distance(a, b) == plain(a, b)
    assert edit_distance([f"a{i}" for i in range(900)], [f"b{i}" for i in range(300)]) == 900


def test_long_pairs_take_the_other_path_and_agree(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = [tuple(" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 60, 200]))) for _ in range(2)) for _ in range(40)] + [(None, "a"), ("a", None), ("", "")]
    df = spark.createDataFrame(rows, "r string, h string")
    want = df.select("r", "h", wer_parts("r", "h").alias("p"), wer("r", "h").alias("w"), word_edit_distance(T.tokenize_words("r"), T.tokenize_words("h")).alias("d")).collect()
    for bound in (0, 20_000):
        monkeypatch.setattr(T, "LONG_CHARS", bound)
        monkeypatch.setattr(T, "LONG_WORDS", bound // 16)
        got = df.select("r", "h", wer_parts("r", "h").alias("p"), wer("r", "h").alias("w"), word_edit_distance(T.tokenize_words("r"), T.tokenize_words("h")).alias("d")).collect()
        assert got == want


def test_a_pair_of_20000_words_is_quick(spark):
    rng = random.Random(3)
    r, h = ([f"t{rng.randrange(30000)}" for _ in range(20000)] for _ in range(2))
    df = spark.createDataFrame([(" ".join(r), " ".join(h)), ("a b", "a c")], "r string, h string")
    df.select(wer("r", "h").alias("w")).collect()  # starts the worker
    start = time.perf_counter()
    got = df.select(wer_parts("r", "h").alias("p")).collect()
    assert time.perf_counter() - start < 5 and got[1].p.edits == 1
    assert got[0].p.ref_words == 20000 and got[0].p.edits == edit_distance(r, h) == pytest.approx(19500, abs=499)
