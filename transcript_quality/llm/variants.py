"""Spelling variants: words one edit apart, found by a frontier that walks a distributed trie level by level.

The trie is a table of edges: node (a prefix of some word), letter, the count of the word that ends behind it, and a 64-bit mark of the letters that
go on from there.  A state (word, position, node, edits) is joined with its node's edges once a level and
gives the states of the next level: the same letter (no edit), another letter, a letter of the trie only, or, on the spot, a letter of the word
only.  A state with an edit is made only where the trie goes on with its next letter or ends.  States whose word is used up at the end of another word, with
one edit, are that word's neighbours.  The frontier is written once a level.

One edit leaves the first or the second half of a word as it is.  So every word walks twice, from the left and, in a trie of reversed words, from the
right, and enters at the node of its first half: edits come only where the trie is deep and thin.  The two tries are one table: a mark before the first letter tells them apart.
The shallowest nodes, where many words enter, are kept ``SALT`` times and the words dealt over them.

Words over ``LONGEST`` letters would need a level a letter; a pair with such a word shares its first or its second half (cut by the
shorter word's length), so these are joined by the hash of a half and checked with the edit distance.

Defined results: null texts have no words; the number of a null doc_id is written as the empty text.  Repeated rows count as often as they come.  Of
near words of equal count the smallest in code-point order is the form.  Words without a near word have n_near 0, no form, and
themselves as root.  Empty tables give no rows; other columns are not read."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transcript_quality.llm.common import stored

SHORTEST, RAREST, MODULUS = 5, 3, 97
#: Runs of fewer letters give no word, with or without a deleted letter; a match starts where its run starts and takes all of it.
RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")
#: Different words a task holds before it hands on their counts.
HELD = 400_000
LONGEST = 64
#: A node of a mark and two letters, the shallowest at which a word enters.
SALT, SHALLOW = 16, 1 + SHORTEST // 2


class WordCounts(dict):
    """Numbers of different runs, with their counts as words.  The crc of an id and a run is put together from the crc of each, so a run is hashed once and not
    once a document."""

    def __init__(self):
        super().__init__()
        self.words: list[str] = []
        self.n, self.size, self.crc = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.uint32)

    def __missing__(self, run: str) -> int:
        i = self[run] = len(self.words)
        self.words.append(run)
        if i == len(self.n):
            self.n, self.size, self.crc = (np.concatenate([x, np.zeros_like(x)]) for x in (self.n, self.size, self.crc))
        data = run.encode()
        self.size[i], self.crc[i] = len(data), zlib.crc32(data)
        return i

    def add(self, doc_id, text: bytes) -> None:
        """Count the words of one text."""
        found = Counter(RUN.findall(text.lower().decode("utf-8", "replace")))  # bytes lower A-Z only
        if not found:
            return
        at = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        times = np.fromiter(found.values(), np.int64, len(found))
        start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
        sizes, which = np.unique(self.size[at], return_inverse=True)
        zeros = [bytes(k) for k in sizes.tolist()]
        moved = np.asarray([zlib.crc32(z, start) ^ zlib.crc32(z) for z in zeros], np.uint32)  # the id's part, as many bytes on
        h = moved[which] ^ self.crc[at]
        cut = h % MODULUS == 0
        self.n[at[~cut]] += times[~cut]
        for i, k, x in zip(at[cut].tolist(), times[cut].tolist(), h[cut].tolist(), strict=True):
            word = self.words[i]
            gone = x % len(word)
            word = word[:gone] + word[gone + 1:]
            if len(word) >= SHORTEST:
                j = self[word]
                self.n[j] += k

    def rows(self) -> pa.RecordBatch:
        n = self.n[:len(self.words)]
        return pa.record_batch([pa.array(self.words, pa.string()), pa.array(n)], ["word", "n"]).filter(pa.array(n > 0))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words with ``RAREST`` occurrences or more."""
    def run(batches):
        counts = WordCounts()
        for b in batches:
            for d, t in zip(b.column(0), b.column(1), strict=True):
                if t.is_valid:
                    counts.add(d.as_py(), t.as_py())
                if len(counts) > HELD:
                    yield counts.rows()
                    counts = WordCounts()
        yield counts.rows()
    rows = docs.select(F.col(id_col).alias("i"), F.col(text).cast("binary").alias("t"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= RAREST)


def _mark(letter: str) -> str:
    """SQL of a letter's bit (0 for the empty string)."""
    return f"CASE WHEN {letter} = '' THEN 0L ELSE shiftleft(1L, ascii({letter}) % 64) END"


def trie(words: DataFrame) -> DataFrame:
    """Edges (node, salt, ch, ends, go) from nodes of SHALLOW letters or more; ends is the count of the word that ends behind the edge, or null."""
    prefix = words.select("word", "n", F.explode(F.expr(f"sequence({SHALLOW + 1}, char_length(word))")).alias("d"))
    edges = (prefix.select(F.expr("substring(word, 1, d)").alias("child"), F.expr("CASE WHEN d = char_length(word) THEN n END").alias("n"),
                           F.expr(_mark("substring(word, d + 1, 1)")).alias("bit"))
             .groupBy("child").agg(F.max("n").alias("ends"), F.bit_or("bit").alias("go")))
    rows = edges.select(F.expr("substring(child, 1, char_length(child) - 1)").alias("node"), F.expr("right(child, 1)").alias("ch"), "ends", "go")
    salts = F.when(F.length("node") <= SHALLOW, F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("salt", F.explode(salts))


#: What follows a state along an edge: letters that meet, a letter of the trie only, or, behind letters that meet, a letter of the word only.
_STEP = """explode(array(struct(i + 1 AS i, CASE WHEN e = 1 OR same THEN e ELSE 1 END AS e, i < char_length(word) AS ok),
                         struct(i AS i, 1 AS e, e = 0 AS ok),
                         struct(i + 2 AS i, 1 AS e, e = 0 AND same AND i + 1 < char_length(word) AS ok)))"""
#: Whether the new state can still end in a word.
_ALIVE = f"""s.ok AND (s.e = 0 OR (s.i = char_length(word) AND ends IS NOT NULL)
             OR (s.i < char_length(word) AND (go & {_mark("substring(word, s.i + 1, 1)")}) != 0))"""


def _near_in_trie(words: DataFrame) -> DataFrame:
    """(word, near, n) for all words of LONGEST letters at most."""
    spark = words.sparkSession
    short = words.where(F.length("word") <= LONGEST)
    words = short.select(F.concat(F.lit(">"), "word").alias("word"), "n").union(short.select(F.concat(F.lit("<"), F.reverse("word")), "n"))
    nodes = stored(trie(words), "trie")
    salt = F.when(F.length("node") <= SHALLOW, F.pmod(F.xxhash64("word"), F.lit(SALT))).otherwise(F.lit(0)).cast("int")
    half = "1 + (char_length(word) - 1) div 2"
    now = words.select("word", F.explode(F.expr(f"array(struct(cast({half} AS int) AS i, 0 AS e), struct(cast({half} + 1 AS int) AS i, 1 AS e))")).alias("s"),
                       F.expr(f"substring(word, 1, cast({half} AS int))").alias("node")).select("word", F.col("s.i").alias("i"), "node", F.col("s.e").alias("e"))
    found = spark.createDataFrame([], "word string, near string, n long")
    ended = "e = 1 AND i = char_length(word)"
    while True:
        met = now.withColumn("salt", salt).join(nodes, ["node", "salt"]).where("e = 0 OR ch = substring(word, i + 1, 1)")
        step = met.withColumn("same", F.expr("ch = substring(word, i + 1, 1)")).select("word", "node", "ch", "ends", "go", F.expr(_STEP).alias("s"))
        now = stored(step.where(_ALIVE).select("word", "s.i", F.concat("node", "ch").alias("node"), "s.e", "ends"), "frontier")
        found = found.union(now.where(ended).select("word", F.col("node").alias("near"), F.col("ends").alias("n")))
        now = now.where(f"NOT ({ended})").drop("ends")
        if now.isEmpty():
            own = [F.when(F.startswith(F.col(c), F.lit("<")), F.reverse(F.substring(c, F.lit(2), F.length(c)))).otherwise(F.substring(c, F.lit(2), F.length(c))).alias(c) for c in ("word", "near")]
            return found.select(*own, "n")


def _near_long(words: DataFrame) -> DataFrame:
    """(word, near, n) of the pairs in which a word has more than LONGEST letters."""
    long = words.where(F.length("word") >= LONGEST).withColumn("m", F.length("word"))
    def halves(rows, m):
        h = F.floor(m / 2).cast("int")
        return rows.withColumn("k", F.explode(F.array(F.xxhash64(m, F.lit("a"), F.substring("word", F.lit(1), h)),
                                                      F.xxhash64(m, F.lit("b"), F.when(m > h, F.expr("right(word, m - cast(floor(m / 2) AS int))")))))
                               ).withColumn("m", m)
    a = halves(long, F.col("m")).select(F.col("word").alias("a"), F.col("n").alias("na"), "m", "k")
    shorter = long.withColumn("m", F.col("m") - 1)
    b = halves(long, F.col("m")).unionByName(halves(shorter, F.col("m"))).select(F.col("word").alias("b"), F.col("n").alias("nb"), "m", "k")
    pair = (a.join(b, ["m", "k"]).where((F.col("a") != F.col("b")) & (F.greatest(F.length("a"), F.length("b")) > LONGEST)
                                        & (F.levenshtein("a", "b", 1) == 1)).select("a", "na", "b", "nb").distinct())
    return pair.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("n")).union(
        pair.select(F.col("b"), F.col("a"), F.col("na"))).distinct()


def neighbours(words: DataFrame) -> DataFrame:
    """words (word, n) -> (word, near, n): all words one edit away, with their counts.  Dealt by word (a word has a bounded number of neighbours), so a
    grouping by word needs no other shuffle."""
    return _near_in_trie(words).union(_near_long(words)).repartition("word").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): each round every word jumps to where its target points."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(then, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        now = stored(step, "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = stored(word_counts(docs, id_col, text), "words")
    near = (neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best"))
            .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")))
    strong = F.col("near_n") >= 2 * F.col("n")
    rows = stored(words.join(near, "word", "left").select(
        "word", F.when(strong, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("near_n")).alias("form_n")), "forms")
    return (rows.join(_roots(rows.where("form is not null")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
