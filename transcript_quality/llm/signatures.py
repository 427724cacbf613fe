"""Ranked lexical search over bit-sliced Bloom signatures.

Index: documents are taken in blocks of similar length.  A block is a matrix of bits: a column a document, a row a hash value; a term sets
``HASHES`` rows of its documents' columns, and again, under another name, for each of ``LEVELS`` that its count reaches.  The
rows are stored packed (slices), with each document's id and length.  Beside the blocks stand the terms with their document counts.

Search: the AND of a term's slices tells which documents of a block may hold it, and those of its levels how often at most; so presence and
counts are never underestimated, and the sums of the terms' weighted contributions are upper bounds of the scores.  A first pass takes
the documents with the highest bounds and scores them exactly: the K-th of their scores is a floor that the answer can't fall
below.  A second pass finds all documents whose bound reaches the floor; these, and no others, are scored exactly from their texts.  No
document is left out otherwise, so the ranks are exact.

Items are the stated query set; they are taken in rounds of about ``ROUND`` bytes, one broadcast each.  Defined results: null and empty texts (documents or
items) have no terms and are never ranked; without any document the answer is empty.  Rows of the same id and different texts are documents of their own;
rows equal in id and score keep both ranks.  A null doc_id goes last among equal scores.  Repeated items (same id and text) are one; other columns are not read."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transcript_quality.llm.common import slices, stored
from transcript_quality.llm.repeats import mix

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
K = 20
HASHES = 3
#: Counts at which a term is entered again; a term that reaches the last may be as frequent as its document is long.
LEVELS = (2, 3, 4, 6, 9, 14, 22)
#: Bits of a signature for each term (and level) of the block's richest document.
BITS = 10
COLUMNS = 2048
SLICE = 16 << 20
ROUND = 4 << 20
LAST = (1 << 63) - 1
_STRIDE = 0x9E3779B97F4A7C15


def terms_of(text: bytes | None) -> list[str]:
    """Terms in order; only A-Z are lower-cased."""
    return TERM.findall(text.lower().decode("utf-8", "replace")) if text else []


def share(tf, m):
    """(10**9 * tf) div (1000 * tf + 12 * m)."""
    return 1000000000 * tf // (1000 * tf + 12 * m)


def hash_of(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term.encode())


def keys_of(hashes: np.ndarray, level: int) -> list[np.ndarray]:
    """The HASHES row numbers (before the modulus) of terms at a level."""
    return [mix(hashes + np.uint64((1 + level * HASHES + j) * _STRIDE & 0xFFFFFFFFFFFFFFFF)) for j in range(HASHES)]


def _block(docs: list[tuple[int, int, np.ndarray, np.ndarray]]) -> tuple[int, int, bytes, bytes, bytes]:
    """(rows, documents, ids, lengths, slices) of documents (id, length, hashes of the terms, their counts)."""
    size = [len(h) for _, _, h, _ in docs]
    hashes, count, col = np.concatenate([h for _, _, h, _ in docs]), np.concatenate([c for *_, c in docs]), np.repeat(np.arange(len(docs)), size)
    more = [np.flatnonzero(count >= least) for least in LEVELS]
    entries = np.bincount(col, minlength=len(docs)) + sum(np.bincount(col[x], minlength=len(docs)) for x in more)
    rows = max(64, BITS * int(entries.max()))
    bits = np.zeros((rows, -(-len(docs) // 8) * 8), np.uint8)
    for level, x in enumerate([slice(None), *more]):
        for k in keys_of(hashes[x], level):
            bits[(k % np.uint64(rows)).astype(np.int64), col[x]] = 1
    return (rows, len(docs), np.asarray([d[0] for d in docs], np.int64).tobytes(), np.asarray([d[1] for d in docs], np.int64).tobytes(), np.packbits(bits, axis=1).tobytes())


_INDEX = "rows int, docs int, ids binary, lengths binary, slices binary, term string, df long"


def index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: blocks, and terms with their document counts (of a slice; they are summed when asked for)."""
    schema = pa.schema([("rows", pa.int32()), ("docs", pa.int32()), ("ids", pa.binary()), ("lengths", pa.binary()), ("slices", pa.binary()), ("term", pa.string()), ("df", pa.int64())])

    def run(batches):
        known: dict = {}
        for b in batches:
            for lo, hi in slices([x or 0 for x in pc.binary_length(b.column(1)).to_pylist()], SLICE):
                held, df = [], Counter()
                if len(known) > 1 << 18:
                    known.clear()
                for d, t in zip(b.column(0).slice(lo, hi - lo).to_pylist(), b.column(1).slice(lo, hi - lo), strict=True):
                    own = terms_of(t.as_py())
                    if own:
                        c = Counter(own)
                        df.update(c.keys())
                        for t in c:
                            if t not in known:
                                known[t] = hash_of(t)
                        held.append((d, len(own), np.fromiter(map(known.__getitem__, c), np.uint64, len(c)), np.fromiter(c.values(), np.int64, len(c))))
                held.sort(key=lambda x: len(x[2]))
                a = 0
                while a < len(held):  # similar numbers of terms, so that the richest sets no needless rows
                    e = a + 1
                    while e < len(held) and e - a < COLUMNS and len(held[e][2]) <= max(64, 1.5 * len(held[a][2])):
                        e += 1
                    yield pa.record_batch([pa.array([x]) for x in _block(held[a:e])] + [pa.nulls(1, pa.string()), pa.nulls(1, pa.int64())], schema=pa.schema(
                        [("rows", pa.int64()), ("docs", pa.int64()), *((n, pa.binary()) for n in ("ids", "lengths", "slices")), ("term", pa.string()), ("df", pa.int64())])).cast(schema)
                    a = e
                n = len(df)
                if n:
                    yield pa.record_batch([pa.nulls(n, f.type) for f in schema][:5] + [pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64())], schema=schema)

    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("d"), F.col(text).cast("binary").alias("t"))
    return stored(rows.mapInArrow(run, _INDEX), "signatures")


def _bounds(row: tuple, queries: list, total: int, length: int):
    """(item, ids, upper bounds) of a block for each item: queries are (item, [(weight, repeats, keys, level keys)])."""
    rows, docs, ids, lengths, packed = row
    ids, n = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64)
    bits = np.frombuffer(packed, np.uint8).reshape(rows, -1)
    m = 75 + 25 * n * total // length
    caps = [share(np.minimum(k - 1, n), m) for k in LEVELS] + [share(n, m)]

    def held(keys):
        at = bits[keys[0] % rows]
        for k in keys[1:]:
            at = at & bits[k % rows]
        return at

    cache: dict = {}
    for item, own in queries:
        sums = np.zeros(docs, np.int64)
        for term, w, keys in own:
            if term not in cache:
                at, got = held(keys[0]), None
                if at.any():
                    got = np.where(np.unpackbits(at)[:docs], caps[0], 0)
                    for j in range(1, len(LEVELS) + 1):
                        at = at & held(keys[j])
                        if not at.any():
                            break
                        got = np.where(np.unpackbits(at)[:docs], caps[j], got)
                cache[term] = got
            if cache[term] is not None:
                sums += w * cache[term]
        yield item, ids, sums


def _best(blocks: DataFrame, shared, total: int, length: int) -> DataFrame:
    """The K documents of each task with the highest bounds, for each item."""
    def run(batches):
        top: dict = {}
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for item, ids, s in _bounds(row, shared.value, total, length):
                    at = np.argsort(-s, kind="stable")[:K]
                    top[item] = heapq.nlargest(K, [*top.get(item, []), *((int(s[i]), int(ids[i])) for i in at if s[i] > 0)])
        rows = [(item, s, d) for item, own in top.items() for s, d in own]
        if rows:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["item", "bound", "d"])
    return blocks.mapInArrow(run, "item long, bound long, d long")


def _reaching(blocks: DataFrame, shared, floors, total: int, length: int) -> DataFrame:
    """All documents whose bound reaches the item's floor."""
    def run(batches):
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for item, ids, s in _bounds(row, shared.value, total, length):
                    at = np.flatnonzero(s >= max(1, floors.value.get(item, 1)))
                    if len(at):
                        yield pa.record_batch([pa.array(np.full(len(at), item)), pa.array(ids[at])], ["item", "d"])
    return blocks.mapInArrow(run, "item long, d long")


def _scored(docs: DataFrame, wanted: DataFrame, shared, total: int, length: int) -> DataFrame:
    """(item, d, score) of the wanted documents, from their texts."""
    def run(batches):
        queries = dict(shared.value)
        for b in batches:
            out = []
            for d, t, items in zip(*(b.column(c) for c in range(3)), strict=True):
                own = Counter(terms_of(t.as_py()))
                m = 75 + 25 * own.total() * total // length
                for item in items.as_py():
                    s = sum(w * share(own[term], m) for term, w, _ in queries[item] if term in own)
                    if s > 0:
                        out.append((item, d.as_py(), s))
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["item", "d", "score"])
    asked = wanted.distinct().groupBy("d").agg(F.collect_set("item").alias("items"))
    return docs.join(asked, "d").select("d", "t", "items").mapInArrow(run, "item long, d long, score long")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's K best documents."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("d"), F.col(text).cast("binary").alias("t"))
    made = index(docs, id_col, text)
    blocks = made.where("docs is not null").select("rows", "docs", "ids", "lengths", "slices")
    count = np.frombuffer
    # documents and terms in all: sums over the blocks' lengths, a row a block
    def sums(batches):
        for b in batches:
            n = [count(x.as_py(), np.int64) for x in b.column(0)]
            yield pa.record_batch([pa.array([sum(map(len, n))], pa.int64()), pa.array([int(sum(x.sum() for x in n))], pa.int64())], ["n", "l"])
    total, length = blocks.select("lengths").mapInArrow(sums, "n long, l long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("l"), F.lit(0))).first()
    asked = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("binary").alias("t")).where("item is not null and t is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    rounds = 1 + size // ROUND
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for r in range(rounds if total else 0):
        mine = {}
        for x in asked.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == r).collect():  # about ROUND bytes
            mine.setdefault(x["item"], []).extend(terms_of(bytes(x["t"])))
        names = spark.createDataFrame([(t,) for t in sorted({t for own in mine.values() for t in own})] or [("",)], "term string")
        df = {x["term"]: x["df"] for x in made.where("term is not null").join(F.broadcast(names), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for t, n in df.items()}
        keys = {t: [[int(k[0]) for k in keys_of(np.asarray([hash_of(t)], np.uint64), level)] for level in range(len(LEVELS) + 1)] for t in weight}
        queries = [(item, [(t, n * weight[t], keys[t]) for t, n in Counter(own).items() if t in weight]) for item, own in sorted(mine.items())]
        shared = spark.sparkContext.broadcast(queries)
        best = (_best(blocks, shared, total, length).withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "d"))).where(F.col("r") <= K).select("item", "d"))
        first = _scored(rows, stored(best, "best"), shared, total, length)
        place = Window.partitionBy("item").orderBy(F.desc("score"), "d")
        floor = first.withColumn("r", F.row_number().over(place)).where(F.col("r") == K).select("item", "score")
        floors = spark.sparkContext.broadcast({x["item"]: x["score"] for x in floor.collect()})  # a number an item
        wanted = stored(_reaching(blocks, shared, floors, total, length), "wanted")
        ranked = _scored(rows, wanted, shared, total, length).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= K)
        out = out.union(ranked.select(F.col("item").alias("item_id"), "rank", F.when(F.col("d") != LAST, F.col("d")).alias("doc_id"), "score"))
    return out


#: DuckDB twin over documents and benchmark.
ORACLE = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT doc_id, w, len(w)::BIGINT AS n FROM lowered WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM docs),
tf AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
q AS (SELECT item_id, term, count(*)::BIGINT AS k FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(k * floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), total GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
