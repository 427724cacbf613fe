"""Quality rules: fixed counts of a text, and a hashed n-gram log-likelihood ratio.

Single words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets.  The bucket counts of all
documents give the raw corpus's multinomial, those of the trusted documents (label quality 1) the target's, both with one added
to each bucket.  A document's score is the mean over its n-grams of ln(p_target / p_raw).  It is kept if the
base rules hold and the score is ``THRESHOLD`` at least; every document is judged by the same fixed number.

Defined results: null and empty texts have no word and fail the base rule (score 0).  Without any trusted document all scores are 0.  A document
with several labels is trusted if all of them say 1.  Repeated rows repeat their result and count as often as
they come; an empty table gives no rows; other columns are not read.  Texts are counted whole, one at a time."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transcript_quality.llm.common import id_bit, id_bitmap

BUCKETS = 1 << 16
THRESHOLD = -0.2
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"
WINDOW = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def repeated_words(words: list[bytes], k: int = WINDOW) -> int:
    """Words that lie in a k-word window found twice or more in the list."""
    n = len(words) - k + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    code = np.asarray([number.setdefault(w, len(number)) for w in words], np.int64)
    kinds = len(number)
    if kinds == len(words):
        return 0
    window, base = code[:n], kinds
    for j in range(1, k):
        if base * kinds >= 1 << 62:
            window = np.unique(window, return_inverse=True)[1]
            base = n
        window, base = window * kinds + code[j:j + n], base * kinds
    order = np.argsort(window, kind="stable")
    same = np.diff(window[order]) == 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + k, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    solid = text.translate(None, SPACE)
    chars = len(solid) - len(solid.translate(None, bytes(range(0x80)) + bytes(range(0xC0, 0x100))))  # less the continuation bytes
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def grams(words: list[bytes]) -> np.ndarray:
    """Buckets of the words and of the pairs of neighbours."""
    c = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    one = (c + np.uint64(1)) * _MIX >> np.uint64(48)
    two = ((c[:-1] * _MIX ^ c[1:] * _MIX2) * _MIX2) >> np.uint64(48)
    return np.concatenate([one, two]).astype(np.int64)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> np.ndarray:
    """ln(p_target / p_raw) of each bucket, from all documents."""
    good = labels.groupBy(F.col(id_col).alias("i")).agg(F.min("quality").alias("q")).where("q = 1 and i is not null").select("i")
    rows = docs.select(F.col(id_col).alias("i"), F.col(text).cast("binary").alias("t")).where("t is not null")

    def counts(texts: DataFrame, name: str) -> DataFrame:
        def count(batches):
            total = np.zeros(BUCKETS, np.int64)
            for b in batches:
                for t in b.column(0):
                    total += np.bincount(grams(t.as_py().split()), minlength=BUCKETS)
            at = np.flatnonzero(total)
            yield pa.record_batch({"bucket": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})
        return texts.mapInArrow(count, "bucket int, n long").select("bucket", *(F.col("n").alias(c) if c == name else F.lit(0).cast("long").alias(c) for c in ("raw", "target")))

    # the corpus is counted where it is read; only texts whose id may be a trusted one (a fixed bitmap tells) go to the join
    shared = docs.sparkSession.sparkContext.broadcast(id_bitmap(good.select(F.col("i").alias("id"))))

    @F.arrow_udf("boolean")
    def may_be_good(at: pa.Array) -> pa.Array:
        x = at.to_numpy()
        return pa.array((shared.value[x >> 3] >> (x & 7).astype(np.uint8) & 1).astype(bool))

    trusted = rows.where(may_be_good(id_bit("i"))).join(good.hint("merge"), "i", "left_semi").select("t")
    both = counts(rows.select("t"), "raw").union(counts(trusted, "target"))

    # at most BUCKETS rows reach the driver
    found = both.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    at = found.column("bucket").to_numpy()
    raw[at] += found.column("raw").to_numpy()
    target[at] += found.column("target").to_numpy()
    if target.sum() == BUCKETS:
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def judge(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    kind = dict(docs.dtypes)[id_col]
    weights = docs.sparkSession.sparkContext.broadcast(ratio)  # BUCKETS doubles, 0.5 MB

    def run(batches):
        llr = weights.value
        for b in batches:
            out = []
            for t in b.column(1):
                raw = t.as_py() or b""
                words = raw.split()
                n = len(words)
                chars, symbols, dup, rep = base_counts(raw, words)
                failed = n < 10 or 100 * rep > 20 * n
                score = float(llr[grams(words)].mean()) if n else 0.0
                out.append((n, chars, symbols, dup, rep, failed, not failed and score >= threshold, score))
            yield pa.record_batch([b.column(0), *(pa.array(c) for c in zip(*out, strict=True))],
                                  ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("binary").alias("t"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, learn(docs, labels))
