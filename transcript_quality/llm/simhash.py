"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits: a bit is 1 if it is set in more than half of the shingles' hashes.  Two
fingerprints link at ``MAX_BITS`` = 4 differing bits or fewer.

Finding the links: the 64 bits are cut into three parts of 22, 21 and 21.  If two fingerprints differ in 4 bits at
most, they differ in 4 // 3 = 1 bit at most in one part.  The anchors of a part are the words of a
covering code: a Hamming code of length 15 on its first 15 bits, every word on the other 6 or 7.  Its
covering radius is 1, so every fingerprint x has an anchor within 1, and a fingerprint y one bit from x is within
2 = radius + threshold of that anchor.  Each fingerprint is copied to all anchors within 2 of it (about 15
a part) and fingerprints of the same anchor are compared over all 64 bits.  No link is missed.

Defined results: a text that is null, empty or without a word has fingerprint zero, which links like any other.  Fewer
words than a shingle: the whole sequence is the one shingle.  Repeated rows share
fingerprint and component.  ``component_id`` is the smallest id that can be reached (null ids never win; a
component with null ids alone has null).  An empty table gives no rows.  Other columns are not touched.
Memory: one text and its hashes at a time; distinct fingerprints only are copied to anchors; an anchor with
very many fingerprints is split (see `components.bucket_cells`)."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transcript_quality.llm.common import arrow_map, stored, text_key
from transcript_quality.llm.components import bit_links, components

SHINGLE = 4
MAX_BITS = 4
PARTS = ((0, 22), (22, 21), (43, 21))  # first bit and length
HAMMING = 15
RADIUS, PART_BITS = 1, 1


def majority(h: np.ndarray) -> int:
    """Fingerprint of unsigned 64-bit hashes, as a signed long."""
    total = np.zeros(64, np.int64)
    for a in range(0, len(h), 1 << 16):
        part = np.ascontiguousarray(h[a:a + (1 << 16)])
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view(np.int64)[0])


def shingle_hashes(text: bytes, k: int = SHINGLE, seed: int = 42) -> np.ndarray:
    """XXH64 of the space-joined k-word shingles of a text, A-Z lower-cased, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    flat = b" ".join(words)
    if len(words) <= k:
        return np.asarray([xxhash.xxh64_intdigest(flat, seed)], np.uint64)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-k])]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(flat[s:e], seed) for s, e in zip(starts, ends[k - 1:], strict=True)), np.uint64, len(starts))


def fingerprint(text: Column, k: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a long."""
    @F.arrow_udf("long")
    def fp(t: pa.Array) -> pa.Array:
        return pa.array([majority(shingle_hashes(x.as_py() or b"", k)) for x in t], pa.int64())
    return fp(text.cast("binary"))


def _flips(length: int) -> list[np.ndarray]:
    """For each syndrome of the Hamming part, the changes of at most RADIUS + PART_BITS bits that lead from a word with that
    syndrome to a word of the code (bit b of the part, b < 15, has syndrome b + 1, other bits 0)."""
    syn = [b + 1 if b < HAMMING else 0 for b in range(length)]
    out: list[list[int]] = [[] for _ in range(HAMMING + 1)]
    out[0].append(0)
    for a in range(length):
        out[syn[a]].append(1 << a)
        for b in range(a):
            out[syn[a] ^ syn[b]].append(1 << a | 1 << b)
    return [np.asarray(x, np.int64) for x in out]


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor key) of every anchor within reach; the key holds the part's number too."""
    rows, keys = [], []
    for p, (first, length) in enumerate(PARTS):
        part = (fps.view(np.uint64) >> np.uint64(first)).astype(np.int64) & ((1 << length) - 1)
        syn = np.zeros(len(part), np.int64)
        for b in range(HAMMING):
            syn ^= (part >> b & 1) * (b + 1)
        for s, flip in enumerate(_flips(length)):
            at = np.flatnonzero(syn == s)
            rows.append(np.repeat(at, len(flip)))
            keys.append(((part[at][:, None] ^ flip) | p << 32).ravel())
    return np.concatenate(rows), np.concatenate(keys)


def _to_anchors(b: pa.RecordBatch) -> list[pa.RecordBatch]:
    fps = b.column(0).to_numpy(zero_copy_only=False)
    out = []
    for a in range(0, len(fps), 4096):
        part = fps[a:a + 4096]
        row, key = anchors(part)
        out.append(pa.record_batch({"key": key, "v": part[row]}))
    return out


def link_fingerprints(fps: DataFrame) -> DataFrame:
    """(fp, root) of the distinct fingerprints (column fp) that have a link."""
    rows = arrow_map(fps.select("fp"), _to_anchors, "key long, v long")
    return components(bit_links(rows, MAX_BITS)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (16 hex digits), component_id."""
    prints = stored(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text), k).alias("fp")), "fingerprints")
    return (_labelled(prints).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def _labelled(prints: DataFrame) -> DataFrame:
    """prints (doc_id, fp, ...) with component_id."""
    kinds = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "kinds")
    roots = kinds.join(link_fingerprints(kinds), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(roots.join(least, "root").select("fp", "component_id"), "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Filter: of each component the row with the smallest id (of equal ids that with the smallest content key; of rows
    equal in both, one; null ids count as largest)."""
    cols = docs.columns
    k1, k2 = (c.alias(f"__k{i}") for i, c in enumerate(text_key(F.col(text))))
    marked = docs.select("*", fingerprint(F.col(text)).alias("__fp"), k1, k2)
    who = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"), F.col("__k0").alias("k0"), F.col("__k1").alias("k1"))
    prints = stored(marked.select(F.col("__fp").alias("fp"), who.alias("doc_id")), "fingerprints")
    keep = _labelled(prints).select(F.col("fp"), "component_id").distinct()
    keep = keep.groupBy("component_id").agg(F.min("fp")).select("component_id")
    same = (F.col("k.component_id.id").eqNullSafe(F.col(f"d.{id_col}")) & (F.col("k.component_id.k0") == F.col("d.__k0"))
            & (F.col("k.component_id.k1") == F.col("d.__k1")))
    return marked.alias("d").join(keep.alias("k"), same, "left_semi").dropDuplicates(["__k0", "__k1", id_col]).select(*cols)
