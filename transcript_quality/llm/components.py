"""Connected components of a distributed edge table, and bit-distance links inside buckets."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transcript_quality.llm.common import released, run_starts, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an undirected edge table (a, b); root is the smallest
    node of its component.

    Alternates large-star and small-star steps until every node points straight at its root: each step points neighbours
    at the smallest node they know.  A step is one minimum per node and a join back, so no task holds
    a neighbourhood, a hub's rows are pre-aggregated, and each round's edges are written to the shared
    folder.  Nodes may be of any type that sorts.  No edges: no rows."""
    now = stored(_clean(edges.select("a", "b")), "edges")
    while not _stars(now):
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        mid = _clean(large)  # a > b
        low = mid.groupBy("a").agg(F.min("b").alias("m"))
        small = mid.join(low, "a")
        now = stored(_clean(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each larger end has one smaller end, which is no larger end itself."""
    twice = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    middle = edges.select("a").join(edges.select(F.col("b").alias("a")), "a", "left_semi")
    return twice.union(middle).isEmpty()


def _clean(edges: DataFrame) -> DataFrame:
    """Each edge once, larger end first, no loops."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def bucket_cells(rows: DataFrame, cap: int) -> DataFrame:
    """Rows (key, ...) with cell columns i, j so that any two rows of a key share a cell and no
    cell holds more than about 2 x cap rows.

    A key with more than ``cap`` rows is dealt into g chunks by a hash of its value v, and a row of chunk c goes to the g
    cells (min(c, x), max(c, x)): the comparisons of a large key spread over many tasks.  The counts are written first; they are
    one row for each oversized key."""
    heavy = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap)
                   .select("key", F.ceil(F.col("n") / cap).cast("int").alias("g")), "heavy")
    chunk = F.pmod(F.xxhash64(F.lit(11), "v"), F.coalesce("g", F.lit(1))).cast("int")
    return (rows.join(heavy, "key", "left").withColumn("c", chunk)
            .withColumn("x", F.explode(F.expr("sequence(0, coalesce(g, 1) - 1)")))
            .withColumn("i", F.least("c", "x")).withColumn("j", F.greatest("c", "x")).drop("g", "c", "x"))


class Gate(NamedTuple):
    """What decides on links if it is more than the bits of v: the ``low`` lowest bits of a key aren't its bucket's but belong to the value, and so
    do the longs named in ``more``.  ``near`` tells of two values (key, v, more; key, v, more) whether they link, ``name`` is the long that a (key, v) goes by.
    Values that differ in ``tight`` bits of v at most link in any case, and a bucket's links of this kind get a forest of their own."""
    low: int
    near: Callable[..., np.ndarray]
    name: Callable[[np.ndarray, np.ndarray], np.ndarray]
    more: tuple[str, ...] = ()
    tight: int = -1


def bit_links(rows: DataFrame, max_bits: int, cap: int = 4096, ratio: float | None = None, gate: Gate | None = None) -> DataFrame:
    """Edges (a, b) between values v (64-bit, distinct inside a key) of the same key that differ in ``max_bits`` bits at
    most: a spanning forest of the links of each cell, so that a dense group of m values gives m - 1
    edges and not m squared.  With a ``ratio`` the rows have a size, and only values link whose smaller size is at least ``ratio`` of the larger.
    With a ``gate`` (and no ratio) it decides on those values that differ in ``max_bits`` bits at most.

    The rows are dealt by key once.  Keys of up to ``cap`` rows are compared where they are; the rows of larger keys are handed on
    as they stream by and are compared in cells, spread over many tasks."""
    extra = {"size": "int"} if ratio is not None else dict.fromkeys(gate.more, "long") if gate else {}
    names = ["v", *extra]
    schema = ", ".join(["a long", "b long", "key long", *(f"{c} {kind}" for c, kind in extra.items())])
    low = gate.low if gate else 0

    def run(batches):
        rest, large = None, None
        for b in batches:
            cols = [np.asarray(b.column(c)) for c in range(1 + len(names))]
            if rest is not None:
                cols = [np.concatenate(p) for p in zip(rest, cols, strict=True)]
            if large is not None:  # more rows of the key whose rows are being handed on
                n = int(np.searchsorted(cols[0] >> low, large, side="right"))
                yield from _handed_on([c[:n] for c in cols], extra)
                cols = [c[n:] for c in cols]
            if gate:  # equal rows once
                starts = run_starts(*cols)
                cols = [c[starts] for c in cols] if len(starts) < len(cols[0]) else cols
            k = cols[0] >> low
            starts = run_starts(k)
            sizes = np.diff(np.append(starts, len(k)))
            rest = cols
            if len(starts):
                sizes[-1] = min(sizes[-1], cap)  # the last key may go on in the next batch
                big = np.repeat(sizes > cap, np.diff(np.append(starts, len(k))))
                cut = int(starts[-1])
                yield from _handed_on([c[big] for c in cols], extra)
                yield from _found(_edges([c[:cut][~big[:cut]] for c in cols], max_bits, ratio, gate), extra)
                rest, large = [c[cut:] for c in cols], None
                if len(rest[0]) > cap:
                    large = int(k[cut])
                    yield from _handed_on(rest, extra)
                    rest = [c[:0] for c in cols]
        if rest is not None:
            yield from _found(_edges(rest, max_bits, ratio, gate), extra)

    first = stored(rows.select("key", *names).repartition(F.shiftright("key", low) if low else F.col("key")).sortWithinPartitions("key", "v").mapInArrow(released(run), schema), "links")
    links, more = first.where("key is null").select("a", "b"), first.where("key is not null").select("key", F.col("a").alias("v"), *names[1:])
    if not more.isEmpty():
        links = links.union(_cell_links(more, max_bits, cap, ratio, gate))
    return links.distinct()


def _handed_on(cols: list[np.ndarray], extra: dict[str, str]):
    n = len(cols[0])
    if n:
        yield pa.record_batch([pa.array(cols[1]), pa.nulls(n, pa.int64()), pa.array(cols[0]), *map(pa.array, cols[2:])], ["a", "b", "key", *extra])


def _found(edges, extra: dict[str, str]):
    for e in edges:
        nulls = [pa.nulls(e.num_rows, t) for t in (pa.int64(), *(pa.int32() if kind == "int" else pa.int64() for kind in extra.values()))]
        yield pa.record_batch([e.column(0), e.column(1), *nulls], ["a", "b", "key", *extra])


def _cell_links(rows: DataFrame, max_bits: int, cap: int, ratio: float | None = None, gate: Gate | None = None) -> DataFrame:
    cells = bucket_cells(rows if gate is None else rows.select(F.shiftright("key", gate.low).alias("key"), F.col("key").alias("whole"), "v", *gate.more), cap)
    if gate:
        cells = cells.drop("key").withColumnRenamed("whole", "key").withColumn("bucket", F.shiftright("key", gate.low))
    deal = ["key" if gate is None else "bucket", "i", "j"]
    names = ["key", "i", "j", "v", *(["size"] if ratio is not None else gate.more if gate else [])]

    def run(batches):
        rest = None
        for b in batches:
            cols = [np.asarray(b.column(k)) for k in range(len(names))]
            if rest is not None:
                cols = [np.concatenate(p) for p in zip(rest, cols, strict=True)]
            last = run_starts(cols[0] >> (gate.low if gate else 0), *cols[1:3])
            cut = last[-1] if len(last) else 0  # the last cell may go on in the next batch
            yield from _edges([c[:cut] for c in cols], max_bits, ratio, gate)
            rest = [c[cut:] for c in cols]
        if rest is not None:
            yield from _edges(rest, max_bits, ratio, gate)

    return (cells.repartition(*deal).sortWithinPartitions(*deal, *([] if gate is None else ["key"]), "v").select(*names)
            .mapInArrow(released(run), "a long, b long"))


def _edges(cols: list[np.ndarray], max_bits: int, ratio: float | None = None, gate: Gate | None = None):
    """cols: keys, perhaps cells (i, j), v and, with a ratio, sizes or what else the gate asks for."""
    at_v = len(cols) - 1 - (len(gate.more) if gate else int(ratio is not None))
    low = gate.low if gate else 0
    starts = run_starts(cols[0] >> low, *cols[1:at_v])
    if gate:  # most values meet none
        alone = np.diff(np.append(starts, len(cols[0]))) == 1
        kept = np.ones(len(cols[0]), bool)
        kept[starts[alone]] = False
        cols = [c[kept] for c in cols]
        starts = run_starts(cols[0] >> low, *cols[1:at_v])
    key, v = cols[0], cols[at_v].astype(np.int64)
    size = None if ratio is None else cols[-1].astype(np.float64)
    if not len(v):
        return
    u = v.view(np.uint64)
    whole = [key, v, *cols[at_v + 1:]]

    def near(x, y):
        bits = np.bitwise_count(u[x] ^ u[y])
        hit = bits <= max_bits
        if size is not None:
            hit &= np.minimum(size[x], size[y]) >= ratio * np.maximum(size[x], size[y]) - 1e-9
        if gate:
            at = np.flatnonzero(hit)
            a, b = x[at], y[at] if np.ndim(y) else y
            hit[at] = gate.near(*(c[a] for c in whole), *(c[b] for c in whole))
        return hit

    def tight(x, y):
        return np.bitwise_count(u[x] ^ u[y]) <= gate.tight

    kinds = [near, tight] if gate and gate.tight >= 0 else [near]
    sizes = np.diff(np.append(starts, len(v)))
    group = np.repeat(np.arange(len(starts)), sizes)
    small = 24
    found_a, found_b = [], []
    idx = np.flatnonzero((sizes[group] <= small) & (sizes[group] > 1))
    end = starts + sizes
    for d in range(1, int(min(small, sizes.max()))):
        idx = idx[idx + d < end[group[idx]]]
        if not len(idx):
            break
        hit = idx[np.bitwise_count(u[idx] ^ u[idx + d]) <= max_bits]
        found_a.append(hit)
        found_b.append(hit + d)
    large = []
    for k in np.flatnonzero(sizes > small):
        few = _few_pairs(u[starts[k]:end[k]], max_bits) if gate else None
        if few is None:
            large.append(np.arange(starts[k], end[k]))
        else:
            found_a.append(few[0] + starts[k])
            found_b.append(few[1] + starts[k])
    pairs = [_forest(kind, members) for members in large for kind in kinds]
    if found_a:
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        for kind in kinds:
            hit = kind(a, b)
            pairs.append(_thinned(a[hit], b[hit], group, sizes))
    a, b = (np.concatenate([p[x] for p in pairs]) if pairs else np.zeros(0, np.int64) for x in (0, 1))
    if len(a):
        yield pa.record_batch({"a": gate.name(key[a], v[a]), "b": gate.name(key[b], v[b])} if gate else {"a": v[a], "b": v[b]})


def _thinned(a: np.ndarray, b: np.ndarray, group: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links, of groups with more of them than a tree has those of a forest only."""
    g = group[a]
    dense = (np.bincount(g, minlength=len(sizes)) >= sizes)[g]
    if not dense.any():
        return a, b
    up: dict[int, int] = {}

    def top(x):
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x
    keep = ~dense
    for i, x, y in zip(np.flatnonzero(dense).tolist(), a[dense].tolist(), b[dense].tolist(), strict=True):
        x, y = top(x), top(y)
        if x != y:
            up[y] = x
            keep[i] = True
    return a[keep], b[keep]


def _few_pairs(u: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """All pairs of values that differ in ``max_bits`` bits at most, if they are few (most buckets hold unlike values); else None."""
    n, left = len(u), 4 * len(u)
    step, found = max(1, (1 << 16) // n), []
    for a in range(0, n - 1, step):
        x, y = np.nonzero(np.bitwise_count(u[a:a + step, None] ^ u[a + 1:]) <= max_bits)
        x, y = x + a, y + a + 1
        later = y > x
        found.append((x[later], y[later]))
        left -= len(found[-1][0])
        if left < 0:
            return None
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _forest(near: Callable, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Breadth-first search: each value is compared with those not reached yet."""
    a, b = [], []
    left = members
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            linked = near(left, x)
            if linked.any():
                hit = left[linked]
                a.append(np.full(len(hit), x))
                b.append(hit)
                queue.extend(hit.tolist())
                left = left[~linked]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))
