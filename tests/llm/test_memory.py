"""Python workers give their memory back when a partition is done."""

import numpy as np
import pyarrow as pa
import pytest

from transcript_quality.llm import common, components, langid, linededup, repeats


class Frame:
    """Keeps the functions that a plan would run in tasks."""

    def __init__(self, kind="long"):
        self.dtypes, self.found = [("id", kind)], []

    def mapInArrow(self, fn, schema):
        self.found.append(fn)
        return self

    def __getattr__(self, name):
        return lambda *a, **k: self


@pytest.fixture()
def counted(monkeypatch):
    times = []
    monkeypatch.setattr(common, "release", lambda: times.append(1))
    return times


def docs():
    ids = pa.array([1, 2], pa.int64())
    return pa.record_batch([ids, ids, ids, pa.array(["a line\nof two", None]).fill_null("")], ["id", "k0", "k1", "text"])


def test_lines_release_once_a_partition(counted):
    frame = Frame()
    linededup._occurrences(frame)
    assert sum(b.num_rows for b in frame.found[0](iter([docs(), docs()]))) == 4
    assert counted == [1]


def test_links_release_once_a_partition(spark, counted, monkeypatch):
    frame = Frame()
    monkeypatch.setattr(components, "stored", lambda df, name: df)
    components.bit_links(frame, 3)
    two = pa.record_batch([pa.array([7, 7], pa.int64()), pa.array([0, 1], pa.int64())], ["key", "v"])
    assert sum(b.num_rows for b in frame.found[0](iter([two]))) == 1
    assert counted[0] == 1


def test_shards_release_once_a_partition(spark, counted, monkeypatch):
    frame = Frame()
    frame.agg = lambda *a: type("A", (), {"first": lambda self: [100]})()
    monkeypatch.setattr(repeats, "stored", lambda df, name: df)
    repeats.repeated_windows(frame)
    texts = pa.record_batch([pa.array([1, 2], pa.int64()), pa.array([3, 4], pa.int64()), pa.array([b"x" * 30 + bytes(range(60))] * 2)], ["id", "key", "t"])
    send, judge = frame.found
    assert len(list(send(iter([texts])))) > 0 and list(judge(iter([]))) == []
    assert counted == [1, 1]


def test_languages_release_each_batch(spark, monkeypatch):
    df = spark.createDataFrame([("the cat sat", "en"), ("der hund ging", "de")], "text string, lang string")
    found = langid.learn(df)
    seen = {}
    monkeypatch.setattr(langid.F, "arrow_udf", lambda kind: lambda fn: lambda col: seen.setdefault("fn", fn))
    times = []
    monkeypatch.setattr(langid, "release", lambda: times.append(1))
    langid.language(langid.F.col("text"), found)
    assert seen["fn"](pa.array(["the cat", None])).field("lang_pred").to_pylist() == ["en", langid.UNKNOWN]
    assert times == [1]


def test_release_gives_memory_back():
    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def run(batches):
        small = [np.zeros(12_000, np.uint8) + 1 for _ in range(8_000)]  # 96 MB under the size that the allocator maps on its own
        pins.extend(small[::400])
        del small
        yield from batches

    pins, before = [], held()
    assert list(common.released(run)(iter([1, 2]))) == [1, 2]
    assert held() - before < 30 << 20
