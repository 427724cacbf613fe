import random

import pytest
from pyspark.sql import functions as F

from transcript_quality.operators import intervals as I
from transcript_quality.operators import monitoring as MON


def plain(steps, width, lo=None, hi=None):
    """Value of every step by adding up the window."""
    ks = [k for k, _ in steps]
    return {k: sum(n for j, n in steps if k - width < j <= k) for k in range(min(ks), max(ks) + 1)}


@pytest.mark.parametrize("partitions", [1, 5])
def test_windows_equal_plain_sums_over_gaps(spark, monkeypatch, partitions):
    monkeypatch.setattr(I, "target_partitions", lambda df: partitions)
    rng = random.Random(partitions)
    series = {g: sorted({rng.randrange(400) if g else rng.choice([0, 1, 2, 900, 901]): 0 for _ in range(n)}) for g, n in ((0, 5), (1, 40), (2, 1))}
    rows = [(g, k, rng.randint(1, 9)) for g, ks in series.items() for k in ks]
    df = spark.createDataFrame(rows, "g int, k long, n long")
    out = I.window_intervals(df, ["n"], F.lit(7).cast("long"), ["g"])
    got = {(r.g, r.k): r.n for r in I.each_step(out).collect()}
    want = {(g, k): v for g in series for k, v in plain([(k, n) for h, k, n in rows if h == g], 7).items()}
    assert got == want
    assert out.count() <= 2 * len(rows)


def test_a_stray_old_event_adds_no_grid(spark):
    df = spark.createDataFrame([("1990-01-01 00:00:00",), ("2024-01-01 00:00:00",), ("2024-01-01 00:00:20",)], "ts string").withColumn("ts", F.to_timestamp("ts"))
    got = MON.rate_intervals(df, "ts", ["5 minutes"], "15 seconds").orderBy("k").collect()
    assert [r.n_in_window for r in got] == [1, 0, 1, 2] and got[1].to - got[1].k > 70_000_000
    assert all(a.to == b.k for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("partitions", [1, 4])
def test_states_equal_a_plain_walk(spark, monkeypatch, partitions):
    monkeypatch.setattr(I, "target_partitions", lambda df: partitions)
    rng = random.Random(partitions)
    ks = sorted(rng.sample(range(300), 60))
    rows = [(k, rng.choice([1, 1, 6])) for k in ks]
    t = spark.createDataFrame([(k * 15 + 1,) for k, n in rows for _ in range(n)], "s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.k: (r.value, r.state) for r in I.each_step(MON.alert_intervals(t, "ts", F.lit(True), "1 minute", "40 seconds", 0.09, "15 seconds")).collect()}
    since, want = None, {}
    for k, n in plain(rows, 4).items():
        since = (k if since is None else since) if n / 60 > 0.09 else None
        want[k] = (n / 60, "inactive" if since is None else "firing" if (k - since) * 15 >= 40 else "pending")
    assert got == {k: (pytest.approx(v), s) for k, (v, s) in want.items()}
    assert {s for _, s in want.values()} == {"inactive", "pending", "firing"}


def test_ratio_mode_and_empty(spark):
    df = spark.createDataFrame([(i, i % 2 == 0) for i in range(40)], "s long, bad boolean").withColumn("ts", F.timestamp_seconds("s"))
    got = MON.error_rate_alert(df, "ts", F.col("bad"), threshold=0.4, mode="ratio").collect()
    assert all(r.value == pytest.approx(0.5, abs=0.04) and r.state == "pending" for r in got) and len(got) == 3
    assert MON.error_rate_alert(df.limit(0), "ts", F.col("bad")).collect() == []
    with pytest.raises(ValueError):
        MON.error_rate_alert(df, "ts", F.col("bad"), mode="share")


def test_steps_are_listed_in_pieces_or_by_their_ends(spark):
    df = spark.createDataFrame([(0, 3, "a"), (3, 3 + 3 * I.PIECE, "b"), (40_000, 40_001, "c")], "k long, to long, v string")
    assert sorted(r.k for r in I.each_step(df).collect()) == [*range(3 + 3 * I.PIECE), 40_000]
    got = sorted((r.k, r.v) for r in I.each_step(df, 5).collect())
    assert got == [(0, "a"), (1, "a"), (2, "a"), (3, "b"), (2 + 3 * I.PIECE, "b"), (40_000, "c")]
