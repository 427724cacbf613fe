"""Language-model scores: a word-frequency base score and a gated recurrent model.

Tokens are the words of a text (A-Z lower-cased) and one end.  Counts cover every training document.  The words that hold
1 / ``FREQUENT`` of the training tokens or more are at most ``FREQUENT`` words, whatever the corpus; they are broadcast.  All other words of a document meet their counts in a
join by word, one row for each distinct word of a document, and come back as one sum a document.

The recurrent model (`gru`) knows the most frequent words.  A word outside its vocabulary costs the probability of that token times a
byte-bigram spelling learned from all such words' counts.  Training: ``WARM_DOCS`` documents (an expected number, chosen by hash) give the start values in one
task, from ``SEGMENT`` tokens each; then each task continues from them over its share of all training documents, every token of every text, by
truncated backpropagation, and the parameters are averaged with the tokens as weights.  Scoring walks whole documents, the state carried
from window to window.

Defined results: a null or empty text is the end token alone.  A null id is a training document.  Without training documents the counts are 0, the base
score is 0 and the model is at its start values.  Repeated rows get equal base scores, and model scores equal up to the rounding of 32-bit sums;
they count as often as they come.  An empty table gives no rows; other columns are not read.  The byte 0 in a word spells like a word's end."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transcript_quality.llm.common import fold, slices, stored
from transcript_quality.llm.gru import LN10, VOCABULARY, Adam, Gru

FREQUENT = 1 << 18
WARM_DOCS = 1500
WARM_PASSES = 2
SEGMENT = 192
RATE = 0.01
END = b""
BLOCK = 4096  # parameters in a row


# ------------------------------------------------------------------ counts
def token_counts(train: DataFrame) -> DataFrame:
    """(word, c) over all training texts (column t, binary); the end is the empty word."""
    def run(batches):
        count: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                count.update((t.as_py() or b"").lower().split())
                if len(count) > 400_000:
                    yield _count_rows(count)
                    count = Counter()
            count[END] += b.num_rows
        if count:
            yield _count_rows(count)
    return train.select("t").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _count_rows(count: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], ["word", "c"])


def spelling(rare: DataFrame) -> np.ndarray:
    """log10 p(byte | byte before) over words (word, c); 0 stands before and after a word."""
    def run(batches):
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            words, c = b.column(0).to_pylist(), b.column(1).to_numpy()
            a = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
            weight = np.repeat(c, [len(w) + 1 for w in words])
            total += np.bincount(a[:-1] << 8 | a[1:], weight, minlength=1 << 16).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["pair", "n"])
    got = rare.select("word", "c").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # 65,536 rows at most
    table = np.ones(1 << 16)
    table[got.column("pair").to_numpy()] += got.column("n").to_numpy()
    table = table.reshape(256, 256)
    return np.log10(table / table.sum(1, keepdims=True)).ravel()


def spell(words: list[bytes], table: np.ndarray) -> float:
    """log10 probability of the spelling of some words."""
    if not words:
        return 0.0
    a = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
    return float(table[a[:-1] << 8 | a[1:]].sum())


# ------------------------------------------------------------------ training
def _ids(words: list[bytes], number: dict[bytes, int]) -> np.ndarray:
    out = np.zeros(len(words) + 1, np.int64)
    out[:-1] = np.fromiter(map(number.get, words, itertools.repeat(1)), np.int64, len(words))
    return out


def _segment(text: bytes, number: dict[bytes, int]) -> np.ndarray:
    ids = _ids(text.lower().split(), number)
    a = zlib.crc32(text) % max(1, len(ids) - SEGMENT + 1)
    return ids[a:a + SEGMENT]


def _whole(text: bytes, number: dict[bytes, int]) -> np.ndarray:
    return _ids(text.lower().split(), number)


def _replica(train: DataFrame, number: dict[bytes, int], theta: np.ndarray, passes: int, cut: Callable[[bytes, dict[bytes, int]], np.ndarray] = _whole) -> DataFrame:
    """Each task trains from theta on its documents (what ``cut`` takes of them); returns its parameters in blocks, times its tokens, with the tokens."""
    shared = train.sparkSession.sparkContext.broadcast((number, theta))

    def run(batches):
        number, theta = shared.value
        net = Gru(theta)
        adam, tokens = Adam(net, RATE), 0
        for b in batches:
            for a, z in slices([t.as_buffer().size if t.is_valid else 0 for t in b.column(0)], 24 << 20):
                texts = [cut(t.as_py() or b"", number) for t in b.column(0).slice(a, z - a)]
                for i, j in slices([len(t) for t in texts], 1 << 18):
                    for _ in range(passes):
                        tokens += adam.learn(texts[i:j])
        if tokens:
            part = TaskContext.get().partitionId() % 64
            flat = net.theta.astype(np.float64) * tokens
            for k in range(0, len(flat), BLOCK):
                yield pa.record_batch([pa.array([k // BLOCK], pa.int32()), pa.array([part], pa.int32()), pa.array([tokens], pa.int64()), pa.array([flat[k:k + BLOCK].tobytes()], pa.binary())], ["block", "part", "tokens", "v"])
    return train.select("t").mapInArrow(run, "block int, part int, tokens long, v binary")


def _sum_blocks(rows: DataFrame, *keys: str) -> DataFrame:
    """Sum of the vectors of each key, a running sum over sorted rows: no group is held."""
    def run(batches):
        key, tokens, total = None, 0, np.zeros(0)

        def out():
            return pa.record_batch([pa.array([key[0]], pa.int32()), pa.array([key[-1]], pa.int32()), pa.array([tokens], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["block", "part", "tokens", "v"])
        for b in batches:
            for r in range(b.num_rows):
                now = tuple(b.column(k)[r].as_py() for k in keys)
                v = np.frombuffer(b.column("v")[r].as_py())
                if now != key:
                    if key is not None:
                        yield out()
                    key, tokens, total = now, 0, np.zeros(len(v))
                tokens += b.column("tokens")[r].as_py()
                total = total + v
        if key is not None:
            yield out()
    return rows.repartition(*keys).sortWithinPartitions(*keys, "tokens").mapInArrow(run, "block int, part int, tokens long, v binary")


def _average(rows: DataFrame, theta: np.ndarray) -> np.ndarray:
    summed = _sum_blocks(_sum_blocks(stored(rows, "replicas"), "block", "part"), "block").toArrow().sort_by("block")  # one model
    if not summed.num_rows:
        return theta
    return (np.frombuffer(b"".join(summed.column("v").to_pylist())) / summed.column("tokens")[0].as_py()).astype(np.float32)


def train_model(train: DataFrame, n_docs: int, number: dict[bytes, int]) -> np.ndarray:
    theta = Gru().theta
    if not n_docs:
        return theta
    every = max(1, n_docs // WARM_DOCS)
    warm = train.where(F.pmod(F.xxhash64("i", "t"), F.lit(every)) == 0).select("t").repartition(1)
    theta = _average(_replica(warm, number, theta, WARM_PASSES, _segment), theta)
    return _average(_replica(train, number, theta, 1), theta)


# ------------------------------------------------------------------ scoring
def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("i"), F.col(text).cast("binary").alias("t"), (fold(id_col, folds) == held).alias("held_out"))
    train = rows.where("not held_out")
    counts = stored(token_counts(train), "token-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    often = counts.where(F.col("c") * FREQUENT >= n).toArrow()  # at most FREQUENT words: their counts add up to n at most
    known = dict(zip(often.column("word").to_pylist(), often.column("c").to_pylist(), strict=True))
    n_docs = known.get(END, 0) or int((counts.where(F.col("word") == F.lit(END)).agg(F.sum("c")).first() or [0])[0] or 0)
    ranked = sorted((w for w in known if w != END), key=lambda w: (-known[w], w))[:VOCABULARY - 2]
    number = {w: k for k, w in enumerate(ranked, 2)}
    listed = F.broadcast(docs.sparkSession.createDataFrame([(bytearray(w),) for w in ranked] or [(bytearray(b""),)], "word binary"))
    letters = spelling(counts.where(F.col("word") != F.lit(END)).join(listed, "word", "left_anti"))
    theta = train_model(train, n_docs, number)
    shared = docs.sparkSession.sparkContext.broadcast((known, number, letters, theta))

    def run(batches):
        known, number, letters, theta = shared.value
        net = Gru(theta)
        log = {w: math.log10(c + 1) for w, c in known.items()}
        end_log, end_known = log.get(END), END in known
        for b in batches:
            for a, z in slices([t.as_buffer().size if t.is_valid else 0 for t in b.column(1)], 24 << 20):
                texts, spelled, base, n_known, n_tokens, rare = [], [], [], [], [], []
                for t in b.column(1).slice(a, z - a):
                    words = (t.as_py() or b"").lower().split()
                    ids = _ids(words, number)
                    texts.append(ids.astype(np.int16))
                    spelled.append(spell([w for w, k in zip(words, ids.tolist()) if k == 1], letters))
                    total, hits, rest = end_log or 0.0, int(end_known), [] if end_known else [(END, 1)]
                    for w, k in Counter(words).items():
                        x = log.get(w)
                        if x is None:
                            rest.append((w, k))
                        else:
                            total += k * x
                            hits += k
                    base.append(total)
                    n_known.append(hits)
                    n_tokens.append(len(ids))
                    rare.append(rest)
                model = net.score(texts) / LN10 + np.asarray(spelled)
                sizes = np.cumsum([0, *map(len, rare)]).astype(np.int32)
                flat = [x for r in rare for x in r]
                pairs = pa.StructArray.from_arrays([pa.array([w for w, _ in flat], pa.binary()), pa.array([k for _, k in flat], pa.int32())], ["word", "k"])
                yield pa.record_batch([b.column(0).slice(a, z - a), b.column(2).slice(a, z - a), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()),
                                       pa.array(model), pa.ListArray.from_arrays(pa.array(sizes), pairs)], ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"])

    first = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<struct<word: binary, k: int>>")
    first = stored(first.withColumn("row", F.monotonically_increasing_id()), "lm-rows")  # numbered once, in the written table
    asked = first.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.k")
    found = (asked.join(counts.hint("shuffle_hash"), "word").groupBy("row")
             .agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("more_base")))
    below = F.lit(math.log10(n + v + 1))
    return (first.drop("rare").join(found, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * below).alias("base_score"), "score"))
