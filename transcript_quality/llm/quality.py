"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

A text's terms are its byte trigrams (case and punctuation kept), hashed into ``BUCKETS`` buckets, and four shares of its words
(new, seen before, equal to the word before, upper case).  Terms are weighted by the root of their share times an inverse document frequency
and projected on the ``RANK`` leading singular directions of the labelled sample.  A text is compared
with every labelled vector by cosine (exact products, in blocks of texts); its ``NEIGHBOURS`` nearest vote with the cosine to the power
``SHARPNESS`` as weight, and the score is the share of the votes for label 1.

The labelled sample is bounded: ``PER_CLASS`` documents of each label, those with the smallest hash of their id among all
labelled documents outside the held-out fold.  It is all that is collected and broadcast (3,000 vectors of 64 numbers).

Defined results: a null or empty text scores 0.  With no labelled text every score is 0, with one label that label's.
Documents whose labels disagree are not learned from; of rows that share an id one is.
Repeated rows repeat their score; ties between equally near vectors go to the first in the sample's order; an empty table gives no
rows; other columns are not read.  Texts are read whole, one at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transcript_quality.llm.common import fold

BUCKETS = 2048
SHARES = 4
RANK = 64
PER_CLASS = 1500
NEIGHBOURS = 15
SHARPNESS = 4
CUT = 0.3
BLOCK = 128


def terms(text: bytes | None) -> np.ndarray:
    """Shares of the hashed trigrams and the word shares of a text."""
    out = np.zeros(BUCKETS + SHARES, np.float32)
    if not text:
        return out
    words = text.split()
    if not words:
        return out
    total = np.zeros(BUCKETS, np.int64)
    for a in range(0, len(text), 1 << 20):  # two bytes of overlap: every trigram once
        c = np.frombuffer(text, np.uint8, min(len(text) - a, (1 << 20) + 2), a).astype(np.uint32)
        if len(c) > 2:
            key = (c[:-2] << np.uint32(16) | c[1:-1] << np.uint32(8) | c[2:]) * np.uint32(2654435761)
            total += np.bincount(key >> np.uint32(21), minlength=BUCKETS)
    out[:BUCKETS] = total / max(1, total.sum())
    n, kinds = len(words), len(set(words))
    upper = sum(map(bytes.isupper, words))
    out[BUCKETS:] = kinds / n, 1 - kinds / n, sum(map(bytes.__eq__, words, words[1:])) / n, upper / n
    return out


class Model:
    """Weights, projection and labelled vectors."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rank: int = RANK):
        self.y = y.astype(np.float64)
        n = max(1, len(x))
        self.idf = np.log((1 + n) / (1 + (x > 0).sum(0))).astype(np.float32) + 1 if len(x) else np.ones(BUCKETS + SHARES, np.float32)
        w = self.weigh(x)
        rng = np.random.default_rng(11)
        q = np.linalg.qr(w @ rng.standard_normal((w.shape[1], min(rank + 16, max(1, len(w))))).astype(np.float32))[0] if len(w) else np.zeros((0, 1), np.float32)
        for _ in range(3):  # randomised range finder for the leading directions
            q = np.linalg.qr(w @ np.linalg.qr(w.T @ q)[0])[0] if len(w) else q
        v = np.linalg.svd(q.T @ w, full_matrices=False)[2][:rank] if len(w) else np.zeros((1, w.shape[1]), np.float32)
        self.v = np.ascontiguousarray(v.T, np.float32)
        self.z = self.project(w)

    def weigh(self, x: np.ndarray) -> np.ndarray:
        w = np.sqrt(x) * self.idf
        return w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-9)

    def project(self, w: np.ndarray) -> np.ndarray:
        z = w @ self.v
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a in range(0, len(texts) if len(self.y) else 0, BLOCK):
            x = np.stack([terms(t) for t in texts[a:a + BLOCK]])
            cos = np.round(self.project(self.weigh(x)) @ self.z.T, 5)
            k = min(NEIGHBOURS, len(self.y))
            near = np.argsort(-cos, axis=1, kind="stable")[:, :k] if cos.shape[1] <= 64 else _first(cos, k)
            w = np.maximum(np.take_along_axis(cos, near, 1), 1e-6).astype(np.float64) ** SHARPNESS
            votes = (w * self.y[near]).sum(1) / w.sum(1)
            out[a:a + BLOCK] = np.where(x.any(1), votes, 0.0)
        return np.clip(out, 0.0, 1.0)


def _first(cos: np.ndarray, k: int) -> np.ndarray:
    """The k largest of each row, of equals the first."""
    edge = -np.partition(-cos, k - 1, axis=1)[:, k - 1:k]
    rank = np.where(cos > edge, 0, np.where(cos == edge, 1, 2)).astype(np.int8)
    return np.argsort(rank, axis=1, kind="stable")[:, :k]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", per_class: int = PER_CLASS) -> Model:
    """docs and labels are what may be learned from."""
    agreed = (labels.where("quality in (0, 1)").groupBy(F.col(id_col).alias("i")).agg(F.min("quality").alias("y"), F.max("quality").alias("y1"))
              .where("y = y1 and i is not null").withColumn("h", F.xxhash64("i"))
              .join(docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("i")), "i", "left_semi"))  # labels of absent or null texts take no place
    pick = [agreed.where(F.col("y") == y).orderBy("h", "i").limit(per_class) for y in (0, 1)]
    chosen = F.broadcast(pick[0].union(pick[1]).select("i", "y", "h"))  # at most 2 * per_class rows
    rows = (docs.select(F.col(id_col).alias("i"), F.col(text).cast("binary").alias("t")).where("t is not null").join(chosen, "i")
            .groupBy("i", "y", "h").agg(F.min_by("t", F.xxhash64("t")).alias("t")))

    def run(batches):
        for b in batches:
            x = [terms(t.as_py()) for t in b.column("t")]
            yield pa.record_batch([b.column("h"), b.column("y"), pa.array([v.tobytes() for v in x], pa.binary())], ["h", "y", "x"])

    got = rows.select("h", "y", "t").mapInArrow(run, "h long, y int, x binary").toArrow().sort_by("h")
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, BUCKETS + SHARES)
    return Model(x, got.column("y").to_numpy())


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", held_out=None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    kind = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            score = shared.value.score([t.as_py() for t in b.column(2)])
            yield pa.record_batch([b.column(0), b.column(1), pa.array(score), pa.array((score >= CUT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held = F.lit(False) if held_out is None else held_out
    return (docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text).cast("binary").alias("t"))
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int"))


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    model = learn(docs, labels.where(fold("doc_id", folds) != held))
    return classify(docs, model, held_out=fold("doc_id", folds) == held)
