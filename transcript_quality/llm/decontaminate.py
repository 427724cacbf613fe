"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame functions only.

A benchmark item is contained in a document if at least ``CONTAINMENT`` = 0.8 of the item's distinct shingles of 5 words are
shingles of the document.  Words are runs of letters and digits, lower-cased.  An item of fewer than 5 words has one shingle, its whole
word sequence, and is looked for among the document's shingles of that length.

Search: items are partitioned by size into classes of 2^c <= shingles < 2^(c+1).  The sketch of an item is its m smallest shingle
hashes, where m follows from its class's upper bound u: m = floor((1 - CONTAINMENT) * (u - 1)) + 1.  More than u - 1 shingles none of
them has, so if 0.8 of an item's shingles are in a document, less than m of them are missing and at least
one of its sketch is there: one shared minimum suffices and none is missed, however long the document is.  A
document's distinct shingle hashes are matched with the sketches; the pairs found are verified with the exact
shingles, as text.

Both sides are keyed by content, so copies of a text are searched once and every row that has the text gets the
hits.  Defined results: null texts and texts without a word hit nothing; items without a word or id are in no document;
repeated rows of documents repeat their hits, repeated items (same id and text) count once; an empty table gives no rows;
other columns are not read by `search` and kept by `clean`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transcript_quality.llm.common import stored, text_key

SHINGLE = 5
CONTAINMENT = 0.8


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(w: Column, k: Column | int) -> Column:
    """Distinct k-word shingles of a word array, as text."""
    k = F.lit(k) if isinstance(k, int) else k
    n = F.size(w) - k + 1
    return F.when(n < 1, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.array_join(F.slice(w, i, k), " "))))


def _hashes(h: Column, k: int) -> Column:
    """Distinct hashes of the k-word shingles, from the words' hashes."""
    n = F.size(h) - k + 1
    return F.when(n < 1, F.array().cast("array<bigint>")).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(k))))))


def items(benchmark: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """Benchmark items with a word: item_id, k (words of a shingle), shingles, and the sketch's hashes."""
    b = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text)).alias("w")).where("item_id is not null").where(F.size("w") > 0).distinct()
    b = b.select("item_id", "w", F.least(F.size("w"), F.lit(SHINGLE)).alias("k"))
    h = F.transform("w", lambda x: F.xxhash64(x))
    by_k = F.coalesce(*(F.when(F.col("k") == k, _hashes(h, k)) for k in range(1, SHINGLE + 1)))
    b = b.select("item_id", "k", _shingles(F.col("w"), F.col("k")).alias("shingles"), F.array_sort(by_k).alias("hashes"))
    size = F.size("shingles")
    upper = F.pow(F.lit(2), F.floor(F.log2(size)) + 1) - 1
    m = (F.floor((1 - CONTAINMENT) * upper + 1e-9) + 1).cast("int")
    return b.select("item_id", "k", "shingles", F.explode(F.slice("hashes", F.lit(1), m)).alias("hash"))


def search(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document row and item it contains: doc_id, item_id, n_shingles, n_found, containment."""
    hits = content_hits(docs, benchmark, text)
    k0, k1 = text_key(F.col(text))
    rows = docs.select(F.col(id_col).alias("doc_id"), k0.alias("k0"), k1.alias("k1"))
    return (rows.join(hits, ["k0", "k1"]).select("doc_id", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment")))


def content_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(k0, k1, item_id, n_shingles, n_found) of the distinct texts that contain an item."""
    index = stored(items(benchmark, item_col, item_text), "items")
    # stored on its own, so that the planner knows its size in files: below the session's broadcast limit it is
    # broadcast, above it both sides are shuffled by hash
    sketch = stored(index.select("k", "hash", "item_id").distinct(), "sketch")
    lengths = sorted(r["k"] for r in index.select("k").distinct().collect())  # 1 to 5: at most five values
    k0, k1 = text_key(F.col(text))
    base = docs.where(F.col(text).isNotNull()).select(k0.alias("k0"), k1.alias("k1"), F.col(text).alias("t"))
    hashed = base.select("k0", "k1", F.transform(words(F.col("t")), lambda x: F.xxhash64(x)).alias("h"))
    probe = None
    for k in lengths or [SHINGLE]:
        one = hashed.select("k0", "k1", F.lit(k).alias("k"), F.explode(_hashes(F.col("h"), k)).alias("hash"))
        probe = one if probe is None else probe.union(one)
    # a pair may share many minima, and a text may come often: one candidate each
    found = stored(probe.join(sketch, ["k", "hash"]).select("k0", "k1", "item_id").distinct(), "candidates")
    texts = base.join(found.select("k0", "k1").distinct(), ["k0", "k1"], "left_semi").dropDuplicates(["k0", "k1"])
    full = index.select("item_id", "k", "shingles").distinct()
    both = texts.select("k0", "k1", words(F.col("t")).alias("w")).join(found, ["k0", "k1"]).join(full, "item_id")
    got = F.size(F.array_intersect("shingles", _shingles(F.col("w"), F.col("k"))))
    return (both.select("k0", "k1", "item_id", F.size("shingles").alias("n_shingles"), got.alias("n_found"))
            .where(F.col("n_found") >= CONTAINMENT * F.col("n_shingles") - 1e-9))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Pipeline form: the rows whose text contains no item; same columns."""
    hits = content_hits(docs, benchmark, text).select("k0", "k1").distinct()
    k0, k1 = text_key(F.col(text))
    keyed = docs.select("*", k0.alias("__k0"), k1.alias("__k1"))
    return keyed.join(hits, (F.col("__k0") == F.col("k0")) & (F.col("__k1") == F.col("k1")), "left_anti").select(*docs.columns)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
i AS (
  SELECT DISTINCT item_id, w, least(len(w), 5) AS k, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda p: array_to_string(w[p:p + least(len(w), 5) - 1], ' '))) AS s
  FROM b WHERE len(w) > 0),
n AS (SELECT item_id, w, count(*) AS n_shingles FROM i GROUP BY item_id, w),
d AS (
  SELECT DISTINCT doc_id, r, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS s
  FROM w, (SELECT DISTINCT k FROM i)),
f AS (SELECT doc_id, r, item_id, i.w, count(*) AS n_found FROM d JOIN i USING (k, s) GROUP BY doc_id, r, item_id, i.w)
SELECT doc_id, item_id, CAST(n_shingles AS INTEGER) AS n_shingles, CAST(n_found AS INTEGER) AS n_found, n_found / n_shingles AS containment
FROM f JOIN n USING (item_id, w) WHERE n_found >= 0.8 * n_shingles - 1e-9
"""
