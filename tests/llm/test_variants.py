"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

from transcript_quality.llm import queries, variants

SF = "/root/testdata/sf0.001"


def words_of(rows):
    out = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    count = words_of(rows)
    cut = {}
    for w in count:  # words that share a deletion, or are one, may be near
        for k in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            cut.setdefault(k, []).append(w)
    near = {w: set() for w in count}
    for group in cut.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda x: (-count[x], x), default=None)
        form[w] = best if best and count[best] >= 2 * n else None
    out = []
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), count[form[w]] if form[w] else None))
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(rows)
    got = result(queries.op13_spelling_variants(spark, SF))
    assert got == want and sum(r[4] > 0 for r in got) > 20 and any(r[1] for r in got)


def test_made_words(spark):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(4, 9))) for _ in range(40)]
    stems += ["a" * 5, "a" * 6, "a" * 7, "b" * 63, "b" * 64, "b" * 65, "b" * 66, "xy" * 60, "xy" * 60 + "z", "q" + "xy" * 60, "xy" * 30 + "w" + "xy" * 30]
    rows = []
    for d in range(60):
        parts = []
        for _ in range(60):
            w = rng.choice(stems)
            if rng.random() < 0.3:
                i = rng.randrange(len(w))
                w = w[:i] + rng.choice(["", "z", w[i] + "z", "É"]) + w[i + 1:]
            parts.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((d if d % 7 else None, " ".join(parts)))
    rows += [(1, None), (2, ""), (3, rows[5][1]), (3, rows[5][1]), (4, "12345 !!")]
    df = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id long, text string, word string, n int")
    assert result(variants.spelling_variants(df)) == brute(rows)


def test_empty(spark):
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert variants.spelling_variants(spark.createDataFrame([(1, "word word")], "doc_id long, text string")).collect() == []
