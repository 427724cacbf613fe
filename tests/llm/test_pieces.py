"""Piece ids against the library's encoder, and round trips."""

import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from transcript_quality.llm import pieces, queries

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "  two  blanks  ", "a\nb\t c", "日本語 x y\x00z", "<s> </s> <unk> <0x41>", "\U0001f600\U0001f600 é", "x" * 70, "ab" * 3000, "=====  ====== !!!!!!"]


def test_query_against_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op1_sentencepiece(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == LIB.encode(texts[r.doc_id]) and r.n_pieces == len(r.ids) and r.decoded_same


def test_random_words():
    rng = random.Random(7)
    some = [LIB.id_to_piece(i) for i in range(300, 32000, 7)]
    texts = ODD + ["".join(rng.choice(some) for _ in range(rng.randrange(1, 12))).replace(pieces.MARK, " ") for _ in range(3000)]
    texts += ["".join(rng.choice("aeinrst ,.-\n") for _ in range(30)) for _ in range(2000)]
    m = pieces.Pieces(PATH)
    for t, got in zip(texts, m.encode(texts), strict=True):
        assert got.tolist() == LIB.encode(t), t
        assert m.decode(got.tolist()) == t == LIB.decode(got.tolist())


def test_edges(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate([*ODD, None, ODD[2], "word " * 50000])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_pieces int")
    got = {r.doc_id: r for r in pieces.round_trip(df, PATH).collect()}
    assert all(got[i].ids == LIB.encode(t) and got[i].decoded_same for i, t, *_ in rows if t is not None)
    assert got[len(ODD)].ids is None and got[len(ODD)].n_pieces == 0 and got[len(ODD)].decoded_same is None
    back = df.select("doc_id", "text", pieces.decode(pieces.encode(F.col("text"), PATH), PATH).alias("again"))
    assert back.where(~F.col("again").eqNullSafe(F.col("text"))).count() == 0
    out = pieces.with_ids(df, PATH)
    assert out.columns == [*df.columns, "piece_ids"] and out.where(F.col("n_pieces") > 0).count() == len(rows) - 2
    assert pieces.round_trip(df.limit(0), PATH).collect() == []


def test_stage_decodes(spark):
    import corpus_pipeline
    rows = [(i, t) for i, t in enumerate([*ODD, None, "un été à l'île", "\u2581 marked"])]
    out = corpus_pipeline.sentencepiece(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert out.columns == ["doc_id", "text", "piece_ids", "n_pieces", "decoded_same"]
    for r in out.collect():
        ids = None if r.text is None else LIB.encode(r.text)
        assert (r.piece_ids, r.n_pieces) == (ids, len(ids or []))
        assert r.decoded_same is (None if ids is None else pieces.model(PATH).decode(ids) == r.text)
    assert {r.doc_id for r in out.where("decoded_same").collect()} >= set(range(len(ODD)))
