"""Language filter: texts in no learned language go, clean texts of every length stay."""

import random

from transcript_quality.llm import langid

SF = "/root/testdata/sf0.01"


def test_unknown_languages_go(spark):
    rng = random.Random(1)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    scripts = {"cyrillic": range(0x430, 0x450), "greek": range(0x3B1, 0x3CA), "cjk": range(0x4E00, 0x5E00), "latin": range(0x61, 0x7B)}

    def made(codes, words):
        return " ".join("".join(chr(rng.choice(codes)) for _ in range(rng.randint(2, 9))) for _ in range(words))
    rows = [(-1 - i, made(codes, words), f"{name} {words}") for name, codes in scripts.items() for words in (2, 150, 1500) for i in range(1000 * words, 1000 * words + 40)]
    strange = spark.createDataFrame([(d, t, None) for d, t, _ in rows], docs.schema)
    got = {(r.doc_id, r.text) for r in langid.keep_languages(docs.union(strange)).collect()}
    clean = {(r.doc_id, r.text) for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert min(sum(c.isalpha() for c in t) for _, t in clean) < 6 and {x for x in got if x[0] >= 0} == clean
    kept = [kind for d, t, kind in rows if (d, t) in got]
    assert not [k for k in kept if not k.startswith("latin")]
    assert kept.count("latin 150") <= 2 and kept.count("latin 1500") <= 4  # two random words can't be told from names
