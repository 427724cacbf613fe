"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of -1 and +1.  A letter in its context (the letter before it, itself, the letter after
it; anything else is the boundary symbol) is the product of the three letters' vectors, each
rolled by its place.  A text's vector is the sum over its letters, a language's prototype the sum over its
training texts, and a text gets the language whose prototype has the largest cosine.

Defined results: a text that is null or has no letter gets ``und`` with score 0; so does every
text if nothing was learned.  Ties go to the language that sorts first.  Rows are judged one by one, so repeated
rows repeat their result, and very long texts are summed slice by slice.  Other columns of the
input are not touched: `identify` returns only the id and its own columns, `with_language` appends two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transcript_quality.llm.common import fold, release, released

DIM = 1024
SEED = 20240611
UNKNOWN = "und"
#: Bound on the prototypes that are broadcast (1024 floats each: 40 MB).
MAX_LANGUAGES = 10_000
#: The filter: standard deviations of noise; letters under which a cosine doesn't decide; share of a language's letters that a letter must hold.
NOISE = 4.0
FEW = 50
COMMON = 10_000
SEGMENT = 1 << 20  # characters of one text worked on at a time
CHUNK = 256        # texts whose count matrix is built at a time
_CODES = 0x110000
_letters: dict[int, np.ndarray] = {}
_is_letter: list[np.ndarray] = []


def _letter_flags() -> np.ndarray:
    if not _is_letter:
        _is_letter.append(np.fromiter((chr(i).isalpha() for i in range(_CODES)), bool, _CODES))
    return _is_letter[0]


def _vector(code: int, dim: int) -> np.ndarray:
    """The fixed random vector of a letter (0: the boundary)."""
    v = _letters.get(code)
    if v is None or len(v) != dim:
        if len(_letters) > 8192:
            _letters.clear()
        bits = np.random.Generator(np.random.Philox(key=[SEED, code])).integers(0, 2, dim, dtype=np.int8)
        v = _letters[code] = (2 * bits - 1).astype(np.int8)
    return v


def _segments(texts: list[str | None]) -> tuple[list[int], list[str]]:
    rows, parts = [], []
    for i, t in enumerate(texts):
        t = t or ""
        if len(t) <= SEGMENT:
            rows.append(i)
            parts.append(t.lower())
            continue
        for a in range(0, len(t), SEGMENT):  # a letter beside a cut has the boundary as its context
            rows.append(i)
            parts.append(t[a:a + SEGMENT].lower())
    return rows, parts


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and gram number of every letter, the grams (three code points each) and letters a row."""
    rows, parts = _segments(texts)
    text = "\0" + "\0".join(parts) + "\0"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    owner = np.repeat(np.asarray(rows, np.int64), [len(p) + 1 for p in parts])
    owner = np.concatenate([owner[:1], owner]) if len(rows) else np.zeros(len(codes), np.int64)
    sym = np.where(_letter_flags()[codes], codes, 0)
    seen = np.zeros(_CODES, bool)
    seen[sym] = True
    seen[0] = True
    alphabet = np.flatnonzero(seen)
    number = np.zeros(_CODES, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    s, a = number[sym], len(alphabet)
    mid = np.flatnonzero(s[1:-1]) + 1
    key = (s[mid - 1] * a + s[mid]) * a + s[mid + 1]
    if a ** 3 <= 1 << 22:
        there = np.zeros(a ** 3, bool)
        there[key] = True
        kinds = np.flatnonzero(there)
        pos = np.zeros(a ** 3, np.int64)
        pos[kinds] = np.arange(len(kinds))
        gram = pos[key]
    else:
        kinds, gram = np.unique(key, return_inverse=True)
    grams = alphabet[np.stack([kinds // (a * a), kinds // a % a, kinds % a], 1)]
    row = owner[mid]
    return row, gram, grams, np.bincount(row, minlength=len(texts))


def _bundle(row: np.ndarray, gram: np.ndarray, grams: np.ndarray, n: int, dim: int) -> np.ndarray:
    """Sum of the gram vectors of each of n rows."""
    out = np.zeros((n, dim), np.float32)
    g = len(grams)
    if not g:
        return out
    counts = np.bincount(row * g + gram, minlength=n * g).reshape(n, g).astype(np.float32)
    codes, inv = np.unique(grams, return_inverse=True)
    base = np.stack([_vector(int(c), dim) for c in codes])
    inv = inv.reshape(grams.shape)
    once, twice = np.roll(base, 1, axis=1), np.roll(base, 2, axis=1)
    for a in range(0, g, 4096):
        k = inv[a:a + 4096]
        out += counts[:, a:a + 4096] @ (twice[k[:, 0]] * once[k[:, 1]] * base[k[:, 2]]).astype(np.float32)
    return out


def text_vectors(texts: list[str | None], dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """Vector and number of letters of each text."""
    vec, letters = np.zeros((len(texts), dim), np.float32), np.zeros(len(texts), np.int64)
    for a, b in _chunks(texts):
        row, gram, grams, n = _grams(texts[a:b])
        vec[a:b], letters[a:b] = _bundle(row, gram, grams, b - a, dim), n
    return vec, letters


def _chunks(texts: list[str | None]):
    a = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > a and (i - a >= CHUNK or size + n > 2 * SEGMENT):
            yield a, i
            a, size = i, 0
        size += n
    if texts:
        yield a, len(texts)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dim: int = DIM) -> dict[str, np.ndarray]:
    """Prototype of each language from all rows with text and language.

    Each task adds up its own rows; the sums of tasks are added by language and dimension, so no
    task or the driver ever holds more than languages x dimensions numbers."""
    def sums(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in _chunks(texts):
                row, gram, grams, _ = _grams(texts[i:j])
                names = sorted(set(langs[i:j]))
                at = np.asarray([names.index(x) for x in langs[i:j]], np.int64)
                for name, v in zip(names, _bundle(at[row], gram, grams, len(names), dim), strict=True):
                    total[name] = total.get(name, 0) + v.astype(np.float64)
        for name, v in total.items():
            yield pa.record_batch({"lang": pa.array([name] * dim), "pos": pa.array(range(dim), pa.int32()), "v": pa.array(v)})

    known = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).where("t is not null and l is not null")
    rows = (known.mapInArrow(released(sums), "lang string, pos int, v double")
            .groupBy("lang", "pos").agg(F.sum("v").alias("v")))
    flat = rows.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("p")).limit(MAX_LANGUAGES + 1).collect()
    if len(flat) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out = {r["lang"]: np.asarray([x["v"] for x in r["p"]]) for r in flat}
    return {k: v / np.linalg.norm(v) for k, v in sorted(out.items()) if v.any()}


def language(text: Column, prototypes: dict[str, np.ndarray], dim: int = DIM) -> Column:
    """Struct (lang_pred, score) of a text column."""
    names = list(prototypes)
    stack = np.stack([prototypes[n] for n in names]).astype(np.float32) if names else np.zeros((0, dim), np.float32)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(t: pa.Array) -> pa.Array:
        texts = t.to_pylist()
        vec, letters = text_vectors(texts, dim)
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        if names and len(texts):
            cos = (vec @ stack.T).astype(np.float64) / np.maximum(np.linalg.norm(vec, axis=1), 1e-9)[:, None]
            best = np.argmax(np.round(cos, 6), axis=1)
            score = np.clip(cos[np.arange(len(texts)), best], 0.0, 1.0)
        ok = (letters > 0) & bool(names)
        del vec, texts
        release()
        return pa.StructArray.from_arrays(
            [pa.array([names[b] if k else UNKNOWN for b, k in zip(best, ok, strict=True)], pa.string()), pa.array(np.where(ok, score, 0.0))],
            ["lang_pred", "score"])

    return predict(text)


def with_language(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """All columns of docs, with ``lang_pred`` and ``score`` in a struct ``__language``."""
    return docs.withColumn("__language", language(F.col(text), prototypes))


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, held: int = 2) -> DataFrame:
    """Learn from the rows outside the held-out fold, predict every row."""
    prototypes = learn(docs.where(fold(id_col, folds) != held), text, lang)
    return (docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, folds) == held).alias("held_out"), language(F.col(text), prototypes).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


def noise_bound(languages: int, dim: int = DIM) -> float:
    """Cosine that a text in none of so many languages hardly reaches: unrelated vectors have a standard deviation of 1 / sqrt(dim),
    whatever their letters, and the largest of several cosines lies sqrt(2 ln languages) of them higher."""
    return (NOISE + float(np.sqrt(2 * np.log(max(1, languages))))) / float(np.sqrt(dim))


def alphabet(docs: DataFrame, text: str = "text", lang: str = "lang") -> frozenset[str]:
    """Letters that hold 1 / ``COMMON`` of a language's letters or more: at most ``COMMON`` a language."""
    def count(batches):
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in _chunks(texts):
                for name in sorted(set(langs[i:j])):
                    codes = np.frombuffer("".join(t for t, x in zip(texts[i:j], langs[i:j], strict=True) if x == name).lower().encode("utf-32-le", "surrogatepass"), "<u4")
                    n = np.bincount(codes, minlength=1)
                    at = np.flatnonzero(n * _letter_flags()[:len(n)])
                    yield pa.record_batch({"lang": pa.array([name] * len(at), pa.string()), "code": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})

    known = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).where("t is not null and l is not null")
    counts = known.mapInArrow(released(count), "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    whole = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    rows = counts.join(whole, "lang").where(F.col("n") * COMMON >= F.col("all")).select("code").distinct()
    return frozenset(map(chr, rows.toArrow().column(0).to_pylist()))


def short_known(text: Column, letters: frozenset[str]) -> Column:
    """Whether a text has letters, fewer than ``FEW``, and half of them or more are in ``letters``."""
    @F.arrow_udf("boolean")
    def run(t: pa.Array) -> pa.Array:
        out = []
        for s in t.to_pylist():
            n = hit = 0
            for c in s or "":
                if c.isalpha():
                    n += 1
                    hit += c.lower()[0] in letters
                    if n == FEW:
                        break
            out.append(0 < n < FEW and 2 * hit >= n)
        return pa.array(out, pa.bool_())
    return run(text)


def keep_languages(docs: DataFrame, text: str = "text", lang: str = "lang", min_score: float | None = None) -> DataFrame:
    """Filter: rows whose language is known and whose cosine reaches ``min_score`` (`noise_bound` if not given); same columns.  A text of fewer
    than ``FEW`` letters, whose cosine may lie under the noise in its own language too, also stays if half of its letters are a language's."""
    prototypes = learn(docs, text, lang)
    least = noise_bound(len(prototypes)) if min_score is None else min_score
    return with_language(docs, prototypes, text).where(
        (F.col("__language.lang_pred") != UNKNOWN) & ((F.col("__language.score") >= least) | short_known(F.col(text), alphabet(docs, text, lang)))).drop("__language")
