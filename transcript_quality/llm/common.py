"""Helpers that the corpus operators share: word splitting, folds, stored tables, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Callable, Iterator
from functools import cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transcript_quality.session import shared_dir

#: Runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return.  On UTF-8
#: bytes this is what ``bytes.split()`` does.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts of one Arrow batch are worked on in slices of about so many bytes, so that a worker's
#: memory follows this figure (or the longest single text) and not the session's batch size.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str | Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; an id that is null is in no held-out fold (-1)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % F.lit(m), F.lit(-1).cast("long"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the cluster's shared folder and read it back.  This cuts the lineage: what
    follows reads finished files, whichever executors are lost meanwhile."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of queries that are done.  It does so when the driver's objects for them are collected, which may
    be long after a large one was read for the last time; some go by the second collection only."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def text_key(text: Column, *more: Column) -> tuple[Column, Column]:
    """A 128-bit content key as two longs.  Null and empty texts differ."""
    nil = F.when(text.isNull(), F.lit(1)).otherwise(F.lit(0))
    return F.xxhash64(nil, text, *more), F.xxhash64(F.lit(7), *more, text, nil)


@cache
def _trim() -> Callable[[int], int]:
    """glibc's ``malloc_trim``; elsewhere nothing is done."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return lambda keep: 0


def release() -> None:
    """Give freed memory back to the system.  Spark keeps idle Python workers, more of them than there are cores, and each would
    hold what its last task used."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that gives its memory back when its partition is done."""
    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()
    return whole


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | list], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                yield from (out if isinstance(out, list) else [out])
    return df.mapInArrow(released(run), schema)


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes, one row at least."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if sizes:
        yield start, len(sizes)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal keys in sorted arrays."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


#: Bits of a bitmap of ids.
ID_BITS = 26


def id_bit(c: str):
    return F.xxhash64(c).bitwiseAND(F.lit((1 << ID_BITS) - 1))


def id_bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** ID_BITS bits (8 MB) in which the ids' bits are set."""
    def run(batches):
        for b in batches:
            for c, bits in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                piece = np.zeros(1 << 15, bool)
                piece[bits.values.to_numpy()] = True
                yield pa.record_batch([pa.array([c], pa.int32()), pa.array([np.packbits(piece, bitorder="little").tobytes()], pa.binary())], ["piece", "bits"])
    at = id_bit("id")
    pieces = ids.select(F.shiftright(at, 15).cast("int").alias("piece"), at.bitwiseAND(F.lit(0x7FFF)).cast("int").alias("bit")).groupBy("piece").agg(F.collect_set("bit").alias("bits"))
    out = np.zeros((1 << (ID_BITS - 15), 1 << 12), np.uint8)
    got = pieces.mapInArrow(released(run), "piece int, bits binary").toArrow()
    for c, bits in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
        out[c] = np.frombuffer(bits, np.uint8)
    return out.ravel()
