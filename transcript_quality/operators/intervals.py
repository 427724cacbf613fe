"""Trailing-window counts and alert states as intervals: exact over any gap, with no grid of steps.

A step that has rows enters every trailing window at its own step and leaves it as many steps later as the window is long.  A
running sum over these two events is the count of the window, constant between two events; so a series of n steps with rows gives
2 n intervals at most, whatever lies between them.  The running sums are made in two levels: events are dealt by range, summed inside each part, and
the parts' totals (one row a part and series) are carried on; no task holds a whole series."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transcript_quality.operators.partitioning import target_partitions
from transcript_quality.session import shared_dir


def dealt_by_range(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """df with ``_part``, the number of its range of keys.  It is written and read again: ranges come from samples, and a part must not change
    when a task is run again."""
    spark = df.sparkSession
    path = shared_dir(spark, "ranges", uuid.uuid4().hex)
    out = df.repartitionByRange(partitions or target_partitions(df), *keys).withColumn("_part", F.spark_partition_id())
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def running(df: DataFrame, group_cols: Sequence[str], order: str, sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None) -> DataFrame:
    """Running sums and maxima up to each row, over rows that `dealt_by_range` dealt by group and order.  Order values are different inside a group."""
    sums, maxima = sums or {}, maxima or {}
    group, here = list(group_cols), [*group_cols, "_part"]
    local = Window.partitionBy(*here).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = df.groupBy(*here).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()], *[F.max(c).alias(f"_{n}") for n, c in maxima.items()])
    carried = parts.select(*here, *[F.sum(f"_{n}").over(before).alias(f"_{n}") for n in sums], *[F.max(f"_{n}").over(before).alias(f"_{n}") for n in maxima])
    plain = [c for c in df.columns if c not in sums and c not in maxima]
    out = df.select(*plain, *[F.sum(c).over(local).alias(n) for n, c in sums.items()], *[F.max(c).over(local).alias(n) for n, c in maxima.items()])
    out = out.join(carried, here)
    return out.select(*plain, *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in sums], *[F.greatest(n, f"_{n}").alias(n) for n in maxima])


def following(df: DataFrame, group_cols: Sequence[str], order: str, last: Column, name: str) -> DataFrame:
    """The order value of the next row of the group, over parts as well; ``last`` behind the last row."""
    here = [*group_cols, "_part"]
    first = df.groupBy(*here).agg(F.min(order).alias("_first"))
    after = first.select(*here, F.lead("_first").over(Window.partitionBy(*group_cols).orderBy("_part")).alias("_next"))
    inside = F.lead(order).over(Window.partitionBy(*here).orderBy(order))
    return df.withColumn(name, inside).join(after, here).withColumn(name, F.coalesce(name, "_next", last)).drop("_next")


def window_intervals(counts: DataFrame, measures: Sequence[str], steps: Column, group_cols: Sequence[str] = ()) -> DataFrame:
    """counts (group..., k, measures...; a row a step that has rows) -> (group..., k, to, measures...): from step k up to ``to`` (not included) each measure's
    sum over the trailing ``steps`` steps, the current one included.  A series goes from its first step with rows to its last one."""
    group = list(group_cols)
    own = counts.withColumn("_steps", steps)
    edges = own.select(*group, F.explode(F.array(
        F.struct(F.col("k").alias("k"), *[F.col(m).alias(m) for m in measures], F.col("k").alias("end")),
        F.struct((F.col("k") + F.col("_steps")).alias("k"), *[(-F.col(m)).alias(m) for m in measures], F.col("k").alias("end")))).alias("e"))
    points = edges.select(*group, "e.*").groupBy(*group, "k").agg(*[F.sum(m).alias(m) for m in measures], F.max("end").alias("end"))
    ends = points.groupBy(*group).agg((F.max("end") + 1).alias("_end"))
    points = dealt_by_range(points.drop("end"), [*group, "k"])
    out = running(points, group, "k", {m: F.col(m) for m in measures})
    out = following(out, group, "k", F.lit(None).cast("long"), "to")
    out = out.join(ends, group) if group else out.crossJoin(F.broadcast(ends))  # ungrouped: one row
    return (out.withColumn("to", F.coalesce(F.least("to", "_end"), "_end")).where(F.col("k") < F.col("to")).drop("_end"))


def state_intervals(series: DataFrame, value: Column, condition: Column, hold_steps: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """series (group..., k, to, _part, ...) -> (group..., k, to, value, state).  The condition is pending from the first step at which it is true and firing once it has held for
    ``hold_steps`` steps; an interval in which it begins to fire is cut there."""
    group = list(group_cols)
    rows = series.select(*group, "k", "to", "_part", value.alias("value"), condition.alias("_on"))
    first = rows.groupBy(*group).agg(F.min("k").alias("_k0"))
    rows = running(rows, group, "k", maxima={"_off": F.when(~F.col("_on"), F.col("to"))})
    rows = rows.join(first, group) if group else rows.crossJoin(F.broadcast(first))
    fire = F.coalesce("_off", "_k0") + F.lit(hold_steps)
    pieces = F.when(~F.col("_on"), F.array(F.struct(F.col("k"), F.col("to"), F.lit("inactive").alias("state")))).otherwise(F.array(
        F.struct(F.col("k"), F.least("to", fire).alias("to"), F.lit("pending").alias("state")),
        F.struct(F.greatest("k", fire).alias("k"), F.col("to"), F.lit("firing").alias("state"))))
    return (rows.select(*group, "value", F.explode(pieces).alias("p")).select(*group, "p.k", "p.to", "value", "p.state").where(F.col("k") < F.col("to")))


#: Steps that are listed by one row's array at once.
PIECE = 4096


def each_step(intervals: DataFrame, longest: int | None = None) -> DataFrame:
    """A row for every step of every interval.  An interval of more than ``longest`` steps gives its first and its last step only, between which nothing
    changes; with None all are listed."""
    last = F.col("to") - 1
    if longest is not None:
        long = F.when(F.col("to") - F.col("k") > longest, F.array(F.col("k"), last))
    else:
        long = F.lit(None).cast("array<bigint>")
    starts = intervals.withColumn("_long", long).withColumn("k", F.explode(F.coalesce("_long", F.sequence(F.col("k"), last, F.lit(PIECE).cast("long")))))
    own = F.when(F.col("_long").isNotNull(), F.array("k")).otherwise(F.sequence(F.col("k"), F.least(last, F.col("k") + (PIECE - 1))))
    return starts.withColumn("k", F.explode(own)).drop("to", "_long")
