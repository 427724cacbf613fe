"""Alerts on a stream of scored rows, with state kept by Spark between micro-batches and restarts.

Rows are first counted by evaluation step (a windowed aggregate in append mode: a step comes out once, when the watermark has passed its end).  The steps then reach a
stateful processor keyed by alert, which holds the steps that are still in the trailing window, the start of the current true run and the last step seen.  That is a
bounded state: one entry a step of the window.  Steps without rows need no message: what they leave out of the window, and whether a hold runs out among them, follows from the
steps around.  The output is what `operators.monitoring.alert_intervals` gives for the same steps."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from transcript_quality.config import MonitorConfig
from transcript_quality.operators.monitoring import seconds

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "alert string, k long, to long, value double, state string"


@dataclass(frozen=True)
class Alert:
    """``hit`` marks the rows that count.  ``mode`` "rate": hits per second of the window; "ratio": hits / rows of the window."""
    name: str
    hit: Column
    window: str
    hold: str
    threshold: float
    mode: str = "rate"


def standard_alerts(is_error: Column, flagged: Column, cfg: MonitorConfig = MonitorConfig()) -> list[Alert]:
    """STM-8 and STM-9 with the configured windows, holds and thresholds."""
    return [Alert("error_rate", is_error, cfg.error_window, cfg.error_hold, cfg.error_threshold),
            Alert("drift", flagged, cfg.drift_window, cfg.drift_hold, cfg.drift_threshold, "ratio")]


def advance(held: list[tuple[int, int, int]], last: int | None, since: int | None, k: int, hits: int, requests: int, rule: tuple):
    """One more step: the intervals (from, to, value, state) up to and including step k, the steps still held, and the start of the true run.

    ``rule``: steps and seconds of the window, steps to hold, threshold, mode."""
    width, window_sec, hold, threshold, mode = rule
    out, at = [], k if last is None else last + 1
    while at <= k:
        if at == k:
            held = [*held, (k, hits, requests)]
        held = [x for x in held if x[0] > at - width]
        # nothing changes before the oldest step leaves, or step k comes
        until = k + 1 if at == k else min([k, *(x[0] + width for x in held[:1])])
        h, r = sum(x[1] for x in held), sum(x[2] for x in held)
        value = h / float(window_sec) if mode == "rate" else (h / r if r else None)
        if value is not None and value > threshold:
            since = at if since is None else since
            cut = min(max(at, since + hold), until)
            out += [(a, b, value, s) for a, b, s in ((at, cut, "pending"), (cut, until, "firing")) if a < b]
        else:
            since = None
            out.append((at, until, value, "inactive"))
        at = until
    return out, held, since


class _Walk(StatefulProcessor):
    def __init__(self, rules: dict[str, tuple]):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("walk", "k array<long>, hits array<long>, requests array<long>, last long, since long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        steps = sorted(x for p in rows for x in zip(p["k"].tolist(), p["hits"].tolist(), p["requests"].tolist(), strict=True))
        held, last, since = [], None, None
        if self.state.exists():
            k, hits, requests, last, since = self.state.get()
            held = list(zip(k, hits, requests, strict=True))
        out = []
        for k, hits, requests in steps:
            more, held, since = advance(held, last, since, int(k), int(hits), int(requests), self.rules[key[0]])
            last = int(k)
            out += [(key[0], *x) for x in more]
        self.state.update(([int(x[0]) for x in held], [int(x[1]) for x in held], [int(x[2]) for x in held], last, since))
        yield pd.DataFrame(out, columns=["alert", "k", "to", "value", "state"]).astype({"value": float})

    def close(self) -> None:
        pass


def alert_stream(scored: DataFrame, ts: str, alerts: list[Alert], step: str, watermark: str = "10 minutes") -> DataFrame:
    """STM-8/9: streaming rows (alert, k, to, value, state); see `operators.monitoring.alert_intervals`.  A step is judged when the watermark has passed it.
    Start it inside `rocksdb_state`: the processor's state needs that store."""
    st = seconds(step)
    rules = {a.name: (seconds(a.window) // st, seconds(a.window), -(-seconds(a.hold) // st), a.threshold, a.mode) for a in alerts}
    rows = scored.select(F.col(ts).cast("timestamp").alias("_ts"), *[a.hit.alias(f"_{i}") for i, a in enumerate(alerts)]).withWatermark("_ts", watermark)
    counts = rows.groupBy(F.window("_ts", step).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), *[F.count_if(f"_{i}").alias(f"_{i}") for i in range(len(alerts))])
    long = counts.select(F.floor(F.unix_seconds("w.start") / st).cast("long").alias("k"), "requests", F.explode(F.array(
        *[F.struct(F.lit(a.name).alias("alert"), F.col(f"_{i}").alias("hits")) for i, a in enumerate(alerts)])).alias("a"))
    return (long.select("a.alert", "k", "a.hits", "requests").groupBy("alert")
            .transformWithStateInPandas(_Walk(rules), OUTPUT, "Append", "None"))


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The state store that stateful processors need, for the queries started inside; the session's own setting comes back after."""
    own = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, own)
