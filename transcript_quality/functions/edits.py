"""Word edit distance of long pairs, bit-parallel.

A column of the distance table is kept as two numbers of as many bits as the reference has words: where the distance rises, and where it falls, from one word
to the next.  A hypothesis word updates all of them at once, so a pair of n and m words takes m steps on n-bit numbers.  Words are compared as they
are: there is no code, and so no bound on their number."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that occur oftener than this in the reference keep their bit pattern; there are at most 1 / KEPT as many as words.
KEPT = 64


def edit_distance(a: Sequence[str], b: Sequence[str]) -> int:
    """Levenshtein distance of two word lists."""
    lo, end_a, end_b = 0, len(a), len(b)
    while lo < end_a and lo < end_b and a[lo] == b[lo]:
        lo += 1
    while end_a > lo and end_b > lo and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    a, b = a[lo:end_a], b[lo:end_b]
    if not a or not b:
        return len(a) + len(b)
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, list[int]] = {}
    wanted = set(b)
    for i, w in enumerate(a):
        if w in wanted:
            places.setdefault(w, []).append(i)
    kept: dict[str, int] = {}

    def pattern(w: str) -> int:
        own = places.get(w)
        if own is None:
            return 0
        if w in kept:
            return kept[w]
        bits = bytearray((own[-1] >> 3) + 1)
        for i in own:
            bits[i >> 3] |= 1 << (i & 7)
        out = int.from_bytes(bits, "little")
        if len(own) > KEPT:
            kept[w] = out
        return out

    n, top = len(a), 1 << (len(a) - 1)
    full = (1 << n) - 1
    rises, falls, distance = full, 0, n
    for w in b:
        match = pattern(w)
        level = (((match & rises) + rises) ^ rises) | match | falls  # no change, or a fall, along the diagonal
        up = falls | (full & ~(level | rises))
        down = rises & level
        distance += (1 if up & top else 0) - (1 if down & top else 0)
        up = (up << 1 | 1) & full
        down = (down << 1) & full
        rises = down | (full & ~(level | up))
        falls = up & level
    return distance


def long_pair_edits(ref_words: Column, hyp_words: Column) -> Column:
    """INT distance of the pairs whose arrays are not NULL.  NULL rows cost next to nothing, so short pairs are best passed as NULL."""
    @F.arrow_udf("int")
    def edits(r: pa.Array, h: pa.Array) -> pa.Array:
        return pa.array([edit_distance(x.as_py(), y.as_py()) if x.is_valid and y.is_valid else None for x, y in zip(r, h, strict=True)], pa.int32())
    return edits(ref_words, hyp_words)
