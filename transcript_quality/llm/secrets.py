"""Secret scans: candidate strings, and a random forest that removes the false ones.

A candidate is a run of at least ``SHORTEST`` letters, digits, ``+ / _ -`` (and closing ``=``) that has a digit or is a provider's key format, or
any value that stands behind an assignment to a credential's name, whatever its length and characters (the formats don't label such a value).  Its features: length, character
shares, entropy, the rates of the 16 transitions between lower case, upper case, digit and other, the share of its characters that dictionary
words cover, what stands right before it, key words and hashed words among its neighbours, and its path (hashed
parts).  The dictionary is the words that hold 1 / ``DICTIONARY`` of all words of all documents or more, so at most that many.

Labelled findings come from a table or, if there is none, from published formats: an access key id of a cloud provider or a value
assigned to a credential's name is a secret; a payment card number (Luhn), an id in hyphens, a number next to a date or a
phone's + is none; others have no label.  The forest never sees a rule's verdict as a feature, is trained on at most ``MAX_LABELLED`` labelled findings of each
label (those with the smallest hash of the value; equal values are one) outside the held-out fold, and judges every candidate.

Defined results: null and empty texts have no candidates; a null path has no path features.  With labels of one kind only all candidates get it;
with none, score 0.5.  Repeated rows repeat their findings.  Empty tables give no rows.  Other columns are not read.  Texts are scanned whole."""

from __future__ import annotations


import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transcript_quality.llm.common import stored
from transcript_quality.llm.lm import END, token_counts
from transcript_quality.session import shared_dir

SHORTEST = 12
DICTIONARY = 1 << 14
MAX_LABELLED = 20_000
TREES, DEPTH, SEED = 40, 8, 17
CUT = 0.5
PATHS = WORDS = 8
AROUND = 60
_RUN = re.compile(r"[A-Za-z0-9+/_\-]{%d,}={0,2}" % SHORTEST)
_DIGIT = re.compile("[0-9]")
# fixed values: names that credentials are assigned to, words of harmless numbers, formats
GOOD_WORDS = ("key", "token", "secret", "password", "passwd", "pwd", "auth", "bearer", "credential", "login")
BAD_WORDS = ("card", "order", "invoice", "phone", "isbn", "uuid", "sha", "md5", "commit", "checksum", "version", "date")
_ASSIGNED = re.compile(r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)[\"']?\s*[:=]\s*[\"']?$", re.I)
_SIGN = re.compile(r"[:=]\s*[\"']?")
_VALUE = re.compile(r"[^\s\"'`,;]+")
_PROVIDER = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{10,}")
_UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)
_DATED = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}.*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def rule_label(value: str, before: str) -> int | None:
    """1: a secret by a published format, 0: harmless by one, None: neither."""
    if _PROVIDER.fullmatch(value) or _ASSIGNED.search(before):
        return 1
    if value.startswith("+") and value[1:].isdigit() or value.isdigit() and 13 <= len(value) <= 19 and luhn(value) or _UUID.fullmatch(value) or _DATED.fullmatch(value):
        return 0
    return None


def coverage(value: str, words: frozenset[str], longest: int) -> float:
    """Share of characters that dictionary words cover, longest first from the left."""
    low, i, hit = value.lower(), 0, 0
    while i < len(low):
        for n in range(min(longest, len(low) - i), 2, -1):
            if low[i:i + n] in words:
                hit += n
                i += n
                break
        else:
            i += 1
    return hit / max(1, len(low))


def features(value: str, before: str, after: str, path: str | None, words: frozenset[str], longest: int) -> list[float]:
    n = len(value)
    kind = np.asarray([0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 for c in value])
    share = np.bincount(kind, minlength=4) / n
    step = np.bincount(kind[:-1] * 4 + kind[1:], minlength=16) / max(1, n - 1)
    count = np.unique(list(value), return_counts=True)[1] / n
    near = re.findall(r"[^\W\d_]+", before.lower())[-3:] + re.findall(r"[^\W\d_]+", after.lower())[:2]
    around, place = np.zeros(WORDS), np.zeros(PATHS)
    for w in near:
        around[zlib.crc32(w.encode()) % WORDS] += 1
    for p in re.split(r"[\W_]+", path or ""):
        if p:
            place[zlib.crc32(p.encode()) % PATHS] += 1
    last = before.rstrip()[-1:]
    return [min(n, 400), *share, sum(c in "0123456789abcdef" for c in value) / n, float(-(count * np.log2(count)).sum()), *step, coverage(value, words, longest),
            float(last == "="), float(last == ":"), float(last in "\"'" and last != ""), float(last == "+"), float(before[-1:] in " \n\t" or not before),
            float(any(w in GOOD_WORDS for w in near)), float(any(w in BAD_WORDS for w in near)), *around, *place]


def dictionary(docs: DataFrame, text: str = "text") -> list[str]:
    """Frequent words of letters, from all documents."""
    counts = stored(token_counts(docs.select(F.col(text).cast("binary").alias("t"))), "dictionary")
    n = counts.agg(F.sum("c")).first()[0] or 0
    often = counts.where((F.col("c") * DICTIONARY >= n) & (F.col("word") != F.lit(END))).select("word").toArrow().column("word").to_pylist()  # at most DICTIONARY
    text_words = (w.decode("utf-8", "replace") for w in often)
    return sorted({w for w in text_words if len(w) > 2 and w.isalpha()})


def found(s: str):
    """(start, end, assigned) of a text's candidates; assigned: only what stands before makes it one, so the formats don't label it."""
    starts = set()
    for m in _RUN.finditer(s):
        if _DIGIT.search(m.group()) or _PROVIDER.fullmatch(m.group()):
            starts.add(m.start())
            yield m.start(), m.end(), False
    for sign in _SIGN.finditer(s):
        a = sign.end()
        if a not in starts and _ASSIGNED.search(s[max(0, a - AROUND):a]) and (m := _VALUE.match(s, a)):
            yield a, m.end(), True


def candidates(docs: DataFrame, words: list[str], id_col: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """doc_id, start (code points), length, f (features), rule (label by format or null), held (crc32 of the value, the fold), value (its 64-bit hash)."""
    kind = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast((frozenset(words), max(map(len, words), default=0)))

    def run(batches):
        known, longest = shared.value
        for b in batches:
            at, start, size, f, rule, crc, value = [], [], [], [], [], [], []
            for r, (t, p) in enumerate(zip(b.column(1), b.column(2).to_pylist(), strict=True)):
                s = t.as_py()
                if not s:
                    continue
                for a, e, assigned in found(s):
                    v, before, after = s[a:e], s[max(0, a - AROUND):a], s[e:e + AROUND]
                    at.append(r)
                    start.append(a)
                    size.append(len(v))
                    f.append(features(v, before, after, p, known, longest))
                    rule.append(None if assigned else rule_label(v, before))
                    crc.append(zlib.crc32(v.encode()))
                    value.append(xxhash.xxh3_64_intdigest(v.encode()) - (1 << 63))
            yield pa.record_batch([b.column(0).take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(f, pa.list_(pa.float64())), pa.array(rule, pa.int32()), pa.array(crc, pa.int64()), pa.array(value, pa.int64())],
                                  ["doc_id", "start", "length", "f", "rule", "held", "value"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("t"), F.col(path).cast("string").alias("p") if path in docs.columns else F.lit(None).cast("string").alias("p"))
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, f array<double>, rule int, held long, value long")


def judge(found: DataFrame, labelled: DataFrame) -> DataFrame:
    """found with score and is_secret; labelled: findings (f, label, h: a hash of the value, so that equal findings are one) to learn from."""
    usable = labelled.where("label in (0, 1)")
    kinds = {int(r["label"]): r["n"] for r in usable.select("label", "h").distinct().groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kinds) < 2:
        score = F.lit({0: 0.0, 1: 1.0}[next(iter(kinds))] if kinds else 0.5)
        return found.withColumn("score", score).withColumn("is_secret", score >= CUT)
    # of each label about twice its sample passes by hash, wherever it lies; of these the first are taken
    picks = []
    for label, n in sorted(kinds.items()):
        share = min(1.0, 2 * MAX_LABELLED / n)
        pool = usable.where((F.col("label") == label) & (F.pmod("h", F.lit(1 << 40)) < F.lit(round(share * (1 << 40)))))
        picks.append(pool.groupBy("h").agg(F.min("f").alias("f")).orderBy("h").limit(MAX_LABELLED).select(array_to_vector("f").alias("features"), F.lit(float(label)).alias("label")))
    pick = stored(picks[0].union(picks[1]), "findings")
    kinds = {k: min(n, MAX_LABELLED) for k, n in kinds.items()}
    weight = F.when(F.col("label") == 1, F.lit(0.5 / kinds[1])).otherwise(F.lit(0.5 / kinds[0])) * sum(kinds.values())
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="w", probabilityCol="p", predictionCol="y", rawPredictionCol="r").fit(pick.withColumn("w", weight))
    # scored with the forest alone, read back from the shared folder: a fitted one keeps its training summary, and with it the session
    path = shared_dir(found.sparkSession, "llm", f"forest-{uuid.uuid4().hex}")
    forest.write().overwrite().save(path)
    forest = RandomForestClassificationModel.load(path)
    out = forest.transform(found.withColumn("features", array_to_vector("f"))).withColumn("score", vector_to_array("p")[1])
    return out.withColumn("is_secret", F.col("score") >= CUT).drop("features", "p", "y", "r")


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = "source", folds: int = 5) -> DataFrame:
    """Findings of all documents: doc_id, start, length, held_out, score, is_secret and the format's verdict (null: none)."""
    found = stored(candidates(docs, dictionary(docs, text), id_col, text, path), "candidates")
    learn = found.where((F.col("held") % folds != 0) & F.col("rule").isNotNull()).select("f", F.col("rule").alias("label"), F.col("value").alias("h"))
    return judge(found, learn).select("doc_id", "start", "length", (F.col("held") % folds == 0).alias("held_out"), "score", "is_secret", "rule")
