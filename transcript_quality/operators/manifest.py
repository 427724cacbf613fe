"""Manifest maintenance: merge, existence filter, seeded exact sample, reference lookup."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transcript_quality.functions.text import base_filename, sanitize_filename, strip_file_scheme
from transcript_quality.operators import stats
from transcript_quality.session import shared_dir


def merge_manifest(existing: DataFrame, new: DataFrame, key: str = "audio_id",
                   max_samples: int | None = None) -> DataFrame:
    """JOB-6 core (JON-4, SET-1, LIM-1): existing rows, then new rows whose key is not already
    present; with ``max_samples`` existing rows come first, each part in key order.

    The anti-join shuffles both sides on the key (AQE handles skew); no side is broadcast since
    both grow with the corpus.  A cap takes the first rows of one part with :func:`first_rows`."""
    fresh = new.join(existing.select(key).distinct(), key, "left_anti")
    if max_samples is None:
        return existing.unionByName(fresh)
    n_existing = existing.count()
    if n_existing >= max_samples:
        return first_rows(existing, key, max_samples)
    return existing.unionByName(first_rows(fresh, key, max_samples - n_existing))


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows of ``df`` in ``key`` order (NULLs first, as ``orderBy``; rows with equal keys in the order of
    a hash of the whole row), without a global sort of rows.

    The keys are counted (a hot key is one row), dealt by range and written with their partition; the
    partition totals, one row each, tell which partition holds the n-th row, and a running sum over that partition's
    keys finds its key.  The result is every row before that key, and of the rows with that key the first by
    hash, found by :func:`stats.value_at_rank`; rows that are equal as a whole fill the rest."""
    if n < 1:
        return df.limit(0)
    spark = df.sparkSession
    counted = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("c"))
    path = shared_dir(spark, "first-rows", uuid.uuid4().hex)
    counted.repartitionByRange(F.col("k").asc_nulls_first()).withColumn("part", F.spark_partition_id()).write.parquet(path)
    keys = spark.read.parquet(path)
    before = 0
    for row in keys.groupBy("part").agg(F.sum("c").alias("c")).orderBy("part").toLocalIterator():
        if before + row["c"] >= n:
            break
        before += row["c"]
    else:
        return df
    order = Window.orderBy(F.col("k").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    last = (keys.where(F.col("part") == row["part"]).withColumn("before", F.coalesce(F.sum("c").over(order), F.lit(0)) + before)
            .where((F.col("before") < n) & (F.col("before") + F.col("c") >= n)).first())
    k = F.col(key)
    head = df.where(F.lit(False) if last["k"] is None else k.isNull() | (k < F.lit(last["k"])))
    tied, need = df.where(k.eqNullSafe(F.lit(last["k"]))), n - last["before"]
    if need == last["c"]:
        return head.unionByName(tied)
    # 52 bits of a hash of the whole row: exact as a double
    pos = F.shiftrightunsigned(F.xxhash64(*df.columns), 12).cast("double")
    cut, upto = stats.value_at_rank(tied.select(pos.alias("v")), last["c"], need - 1)
    front = tied.where(pos < F.lit(cut))
    same = tied.where(pos == F.lit(cut)).limit(need - front.count()) if upto > need else tied.where(pos == F.lit(cut))
    return head.unionByName(front).unionByName(same)


def existing_audio(manifest: DataFrame, files: DataFrame, path_col: str = "audio_path",
                   file_path_col: str = "path", by: str = "filename") -> DataFrame:
    """JON-5: manifest rows whose audio file exists among ``files`` (semi join), matched on the
    base filename (``by='filename'``) or the scheme-stripped full path (``by='path'``)."""
    if by == "filename":
        mk, fk = base_filename(F.col(path_col)), base_filename(strip_file_scheme(F.col(file_path_col)))
    else:
        mk, fk = strip_file_scheme(F.col(path_col)), strip_file_scheme(F.col(file_path_col))
    present = files.select(fk.alias("_k")).distinct()
    return manifest.join(present, mk == F.col("_k"), "left_semi")


def sample_order(key, seed: int = 42) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), (F.col(key) if isinstance(key, str) else key).cast("string")))


def sample_exact(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """LIM-2: seeded sample without replacement of exactly min(n, rows) rows: the n first rows
    in md5(seed|key) order (ties by key), stable under repartitioning.

    The order value of the n-th row is found by distributed counting (:func:`stats.value_at_rank`); the sample is every row
    before it and the first of the few that share it, so no task holds the sample."""
    if n < 1:
        raise ValueError(f"sample_size must be >= 1, got {n}")
    # the first 13 hex digits of the md5 as a double: exact (52 bits) and in md5 order
    order = sample_order(key, seed)
    h = df.withColumn("_sample_pos", F.conv(F.substring(order, 1, 13), 16, 10).cast("double"))
    total = h.count()
    if total <= n:
        return df
    cut, upto = stats.value_at_rank(h.select(F.col("_sample_pos").alias("v")), total, n - 1)
    if upto == n:
        return h.where(F.col("_sample_pos") <= F.lit(cut)).drop("_sample_pos")
    below = h.where(F.col("_sample_pos") < F.lit(cut))
    tied = h.where(F.col("_sample_pos") == F.lit(cut)).withColumn("_sample_key", F.concat_ws("|", order, F.col(key).cast("string")))
    return below.unionByName(first_rows(tied, "_sample_key", n - below.count()).drop("_sample_key")).drop("_sample_pos")


def reference_lookup(manifest: DataFrame, path_col: str = "audio_path",
                     text_col: str = "reference_text") -> DataFrame:
    """JOB-7 core (STR-3): (filename, reference_text) with sanitised base filenames; rows with an
    empty or missing text are dropped."""
    name = sanitize_filename(base_filename(strip_file_scheme(F.col(path_col))))
    return manifest.select(name.alias("filename"), F.col(text_col).alias("reference_text")) \
        .where(F.col("reference_text").isNotNull() & (F.col("reference_text") != ""))
