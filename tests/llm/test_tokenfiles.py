"""Token files against the library's ids, and exact round trips of the file format."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from transcript_quality.llm import queries, tokenfiles

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(docs):
    """docs in file order -> (doc_id, start, n_tokens, crc32)."""
    lib, out, start = Tokenizer.from_file(PATH), [], 0
    for d, t in docs:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_library(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(tuple(r) for r in queries.op8_token_files(spark, SF).collect()) == brute(docs)


def test_chunks_are_exact():
    texts = ["a  b\n\n c\t\td ", "  x", "don't  stop'll\r\n", "a\x1cb \x1c c", "x\xa0y \xa0 z\xa0", "\x85 a\x85b  c　d", "<|endoftext|> a<|endoftext|>b", "!!! ??\n!", "a½.b²,c e\u0301.x _y_.z a_b.c x's't. 3.a a.3 ...", "it's John's're 'tis", "日本語 テキスト", " ", "\n", "q" * 300 + " w", "1 22  333"]
    enc = tokenfiles.Encoder(PATH)
    for _ in range(2):
        for t, got in zip(texts, enc.encode(texts), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == enc.lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_segments():
    rng = np.random.default_rng(2)
    for n in (0, 1, 255, 256, 257, 5000):
        ids = np.where(rng.random(n) < 0.05, rng.integers(0, 2**32, n), rng.integers(1000, 1000 + 2 ** int(rng.integers(0, 17)), n)).astype(np.uint32)
        sizes = np.asarray([n // 3, n - n // 3])
        data = tokenfiles.write_segment(ids, sizes)
        back, got = tokenfiles.read_segment(data)
        assert back.tolist() == ids.tolist() and got.tolist() == sizes.tolist()
        part, _ = tokenfiles.read_segment(data, 1, 3)
        assert part.tolist() == ids[256:768].tolist()
    assert len(tokenfiles.write_segment(np.full(4096, 7), np.asarray([4096]))) < 400


def test_edges(spark):
    rows = [(3, "b c"), (1, None), (2, ""), (3, "b c"), (None, "null id"), (9, "long text " * 40000), (-4, "first")]
    df = spark.createDataFrame([(d, t, 0, b"z") for d, t in rows], "doc_id long, text string, part int, data binary")
    got = sorted((tuple(r) for r in tokenfiles.read(tokenfiles.write(df, PATH)).collect()), key=lambda r: r[1])
    assert got == brute([(None, "null id"), (-4, "first"), (1, None), (2, ""), (3, "b c"), (3, "b c"), (9, "long text " * 40000)])
    assert tokenfiles.read(tokenfiles.write(df.limit(0), PATH)).collect() == []


def test_a_word_is_encoded_once():
    """Whatever follows a word, the library's model is asked for it once; the ids are the library's all the same."""
    lib, coder, asked = Tokenizer.from_file(PATH), tokenfiles.Encoder(PATH), []
    model = coder.model

    class Asked:
        def tokenize(self, word):
            asked.append(word)
            return model.tokenize(word)

    coder.model = Asked()
    texts = ["so thinwhble, thinwhble. thinwhble; thinwhble", "x1.a,b_c,dé.éf, gäh. _i.\tthinwhble\n j.k", "中文,abc，def."]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert asked.count("Ġthinwhble") == 1
    assert " thinwhble" in coder and not [c for c in coder if c[:10] == " thinwhble" and c != " thinwhble"]


def test_every_width_comes_back():
    rng = np.random.default_rng(4)
    for width in range(1, 33):
        ids = rng.integers(0, 1 << width, 3 * tokenfiles.BLOCK + 7, dtype=np.uint64).astype(np.uint32)
        got, sizes = tokenfiles.read_segment(tokenfiles.write_segment(ids, np.asarray([len(ids)])))
        assert (got == ids).all() and sizes.tolist() == [len(ids)]
