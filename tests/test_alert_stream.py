import random

import pytest
from pyspark.sql import functions as F

from transcript_quality.config import MonitorConfig
from transcript_quality.operators import monitoring as MON
from transcript_quality.operators.intervals import each_step
from transcript_quality.sinks.writers import write_stream
from transcript_quality.streaming import alerts as A

CFG = MonitorConfig(error_window="1 minute", error_hold="40 seconds", error_threshold=0.09, drift_window="2 minutes", drift_hold="1 minute", drift_threshold=0.4)


@pytest.mark.parametrize("seed", range(20))
def test_advance_equals_a_plain_walk(seed):
    rng = random.Random(seed)
    steps = [(k, rng.randint(0, 5), 5) for k in sorted(rng.sample(range(120), 30))]
    mode = rng.choice(["rate", "ratio"])
    rule = (4, 60, 3, 0.09 if mode == "rate" else 0.5, mode)
    held, last, since, got = [], None, None, {}
    for k, h, r in steps:
        out, held, since = A.advance(held, last, since, k, h, r, rule)
        last = k
        assert len(held) <= 4
        for a, b, v, s in out:
            got.update({j: (v, s) for j in range(a, b)})
    want, run = {}, None
    for k in range(steps[0][0], steps[-1][0] + 1):
        h, r = (sum(x[i] for x in steps if k - 4 < x[0] <= k) for i in (1, 2))
        v = h / 60 if mode == "rate" else (h / r if r else None)
        run = (k if run is None else run) if v is not None and v > rule[3] else None
        want[k] = (v, "inactive" if run is None else "firing" if k - run >= 3 else "pending")
    assert got == want


def test_stream_with_restarts_equals_batch(spark, tmp):
    rng = random.Random(8)
    seconds = sorted(rng.choice([rng.randrange(0, 900), rng.randrange(3000, 3600)]) for _ in range(700))
    rows = [(s, rng.random() < (0.9 if 300 < s < 700 else 0.1)) for s in seconds]
    df = spark.createDataFrame(rows, "s long, bad boolean").select(F.timestamp_seconds("s").alias("ts"), "bad", "s")
    alerts = A.standard_alerts(F.col("bad"), F.col("bad"), CFG)
    for lo, hi in ((0, 400), (400, 800), (800, 4000)):  # each landing is read by a new query on the same checkpoint
        df.where(f"s >= {lo} and s < {hi}").write.mode("append").parquet(f"{tmp}/landing")
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp}/landing")
        with A.rocksdb_state(spark):
            write_stream(A.alert_stream(stream, "ts", alerts, CFG.step, "0 seconds"), f"{tmp}/out", f"{tmp}/checkpoint")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != A._ROCKSDB
    got = {(r.alert, r.k): (r.value, r.state) for r in each_step(spark.read.parquet(f"{tmp}/out").select("alert", "k", "to", "value", "state")).collect()}
    want = {}
    for name, alert in (("error_rate", MON.error_rate_alert(df, "ts", F.col("bad"), CFG)), ("drift", MON.drift_alert(df, "ts", F.col("bad"), CFG))):
        want.update({(name, r.step_end // 15 - 1): (r.value, r.state) for r in alert.collect()})
    final = max(k for _, k in want)
    assert got == {x: v for x, v in want.items() if x[1] < final}  # the watermark has not passed the last step
    assert {s for _, s in got.values()} == {"inactive", "pending", "firing"}
