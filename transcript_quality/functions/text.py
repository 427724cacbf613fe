"""Path and text expressions, and word error rate as a native Spark expression.

WER = word-level Levenshtein distance / number of reference words.  Tokenisation follows the
common WER convention: runs of two or more whitespace characters become one space, the text is
stripped, and it is split on single spaces (case and punctuation are kept).

The word-level distance is computed by Spark's built-in character ``levenshtein``: each word of
a pair is coded as one supplementary-plane Unicode character, so two words are equal exactly when
their characters are equal.  The code is a 20-bit hash of the word whenever that hash is
injective on the pair's vocabulary (checked per pair), otherwise the word's position among the
distinct words of the pair's shorter side (0 for words only the longer side has).  That stays inside the JVM and costs O(n*m) per pair; nothing is shuffled.
Pairs of long texts go to the bit-parallel distance of `functions.edits` instead, which needs no code for their words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transcript_quality.functions.core import col_of as _c, let
from transcript_quality.functions.edits import long_pair_edits

# a pair is long from this product of its texts' characters, or of its word counts, on
LONG_CHARS = 12_000 ** 2
LONG_WORDS = 2_000 ** 2


def base_filename(path) -> Column:
    """Last path component (like ``os.path.basename``)."""
    return F.element_at(F.split(_c(path), "/"), -1)


def strip_file_scheme(path) -> Column:
    """Remove every ``file:`` occurrence."""
    return F.replace(_c(path), F.lit("file:"), F.lit(""))


def sanitize_filename(name) -> Column:
    """Colons become dashes."""
    return F.translate(_c(name), ":", "-")


def tokenize_words(text) -> Column:
    """ARRAY<STRING> of words; NULL text gives an empty array."""
    s = F.regexp_replace(F.coalesce(_c(text), F.lit("")), r"(?U)\s\s+", " ")
    s = F.regexp_replace(s, r"(?U)^\s+|\s+$", "")
    return F.filter(F.split(s, " "), lambda w: w != "")


def _char(code_point: Column) -> Column:
    return F.format_string("%c", code_point.cast("int"))


def _hash_code(w: Column) -> Column:
    """20-bit hash of the word as a code point in U+10000 .. U+10FFFF."""
    return F.xxhash64(w).bitwiseAND(0xFFFFF) + F.lit(0x10000)


def _code_words(words: Column, vocab: Column) -> Column:
    """Each word -> one character U+10000 + (1-based position in ``vocab``): always injective."""
    return F.array_join(F.transform(words, lambda w: _char(F.array_position(vocab, w) + F.lit(0x10000))), "")


def _hash_words(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: _char(_hash_code(w))), "")


def _distance(r: Column, h: Column) -> Column:
    """Hash coding is O(1) per word; it is used when it is injective on the pair's vocabulary
    (checked exactly).  Otherwise each word is coded by its position among the distinct words
    of the shorter side: a word only the longer side has gets position 0, a code the shorter
    side never uses.  Such words never match anything, so sharing one code among themselves
    changes no distance, and the cost is O((n + m) * distinct words of the shorter side)."""
    def coded(v):
        injective = F.size(F.array_distinct(F.transform(v["u"], _hash_code))) == F.size(v["u"])
        return (F.when(injective, F.levenshtein(_hash_words(r), _hash_words(h)))
                .otherwise(F.levenshtein(_code_words(r, v["s"]), _code_words(h, v["s"]))))
    shorter = F.when(F.size(r) <= F.size(h), r).otherwise(h)
    return let(F.struct(F.array_distinct(F.concat(r, h)).alias("u"), F.array_distinct(shorter).alias("s")), coded)


def _product(a: Column, b: Column) -> Column:
    return F.coalesce(a.cast("long") * b.cast("long"), F.lit(0))


def word_edit_distance(ref_words, hyp_words) -> Column:
    """Word-level Levenshtein distance between two ARRAY<STRING> columns."""
    r, h = _c(ref_words), _c(hyp_words)
    long = _product(F.size(r), F.size(h)) >= F.lit(LONG_WORDS)
    short = F.struct(F.when(~long, r).alias("r"), F.when(~long, h).alias("h"))
    return F.when(long, long_pair_edits(F.when(long, r), F.when(long, h))).otherwise(let(short, lambda p: _distance(p["r"], p["h"])))


def wer_parts(reference, hypothesis) -> Column:
    """STRUCT<ref_words INT, hyp_words INT, edits INT> with each text tokenised once."""
    ref, hyp = _c(reference), _c(hypothesis)
    long = _product(F.length(ref), F.length(hyp)) >= F.lit(LONG_CHARS)

    def parts(r, h, edits):
        return F.struct(F.size(r).alias("ref_words"), F.size(h).alias("hyp_words"), edits.alias("edits"))
    short = F.struct(tokenize_words(F.when(~long, ref)).alias("r"), tokenize_words(F.when(~long, hyp)).alias("h"))
    r, h = (F.when(long, tokenize_words(F.when(long, t))) for t in (ref, hyp))
    return F.when(long, parts(r, h, long_pair_edits(r, h))).otherwise(let(short, lambda p: parts(p["r"], p["h"], _distance(p["r"], p["h"]))))


def wer(reference, hypothesis) -> Column:
    """Word error rate; NULL when the reference has no words (the computation is undefined)."""
    return let(wer_parts(reference, hypothesis),
               lambda w: F.try_divide(w["edits"].cast("double"), w["ref_words"].cast("double")))


def wer_with_policy(reference, hypothesis, missing: float = -1.0, failed: float = -1.0) -> Column:
    """WER with the ingest policy: no (or empty) reference -> ``missing``; a reference without
    words -> ``failed``; a missing hypothesis counts as the empty string."""
    ref = _c(reference)
    value = wer(ref, F.coalesce(_c(hypothesis), F.lit("")))
    return (F.when(ref.isNull() | (ref == ""), F.lit(missing))
            .otherwise(F.coalesce(value, F.lit(failed))))
