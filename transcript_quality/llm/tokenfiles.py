"""Token ids in patched frame-of-reference files.

The ids of all texts, each closed by the id ``END`` = 0, are written in ascending order of the document id.  A file is one
segment of whole documents: header, tokens of each document, start of each block, blocks.  A block holds
``BLOCK`` ids: its minimum, the bit width that ``PERCENTILE`` of the differences from the minimum fit in, the differences' low bits
packed at that width, and a list of exceptions (place and full difference) for the larger ones.

Segments are rows of a Parquet table in the shared folder, one binary value each, with the partition and the number
inside it, the counts and the document ids.  So Spark's commit protocol covers lost executors, and the
files may lie in any store that Spark writes.  `read` decodes them again, all or one block range.

Order: documents are dealt by range of (id, content key), so one id may hold any share of the rows; nulls come first,
rows with equal ids follow their content key; equal rows are interchangeable.  ``start`` adds partition totals (one row
a partition) and then segments of a partition.

Defined results: a null or empty text is the end id alone; an empty table gives no rows; texts are never cut, a very long one is a
segment of its own; other columns are not read."""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transcript_quality.llm.common import slices, stored

END = 0
BLOCK = 256
PERCENTILE = 0.9
SEGMENT_IDS = 1 << 20
CACHE_CHUNKS = 400_000
MAGIC = b"TQPF"
_HEADER = struct.Struct("<4sIIIQ")  # magic, ids in a block, documents, blocks, ids
_CHUNK = re.compile(r"\s*(?:[A-Za-z]++(?!\w)|\S+)|\s+")  # letters before punctuation are a chunk of their own
_HEAD = re.compile(r"\s*[^\W\d_]+(?=[^\w\s])")  # the same for any letters
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]
_WHOLE = re.compile(r"[\x1c-\x1f]")  # white space to Python, not to the tokenizer


# ------------------------------------------------------------------ file format
def _widths(delta: np.ndarray) -> np.ndarray:
    return np.searchsorted(1 << np.arange(32, dtype=np.int64), delta.astype(np.int64), side="right").astype(np.int64)


def _pack(delta: np.ndarray, width: int) -> np.ndarray:
    """(n, BLOCK) values -> (n, bytes): the low ``width`` bits of each."""
    if width in (8, 16):  # whole bytes: the same layout without taking bits apart
        return np.ascontiguousarray(delta.astype(f"<u{width // 8}")).view(np.uint8).reshape(len(delta), -1)
    size = 1 if width < 8 else 2 if width < 16 else 4
    bits = np.unpackbits(np.ascontiguousarray(delta.astype(f"<u{size}")).view(np.uint8).ravel(), bitorder="little").reshape(-1, 8 * size)
    return np.packbits(bits[:, :width].reshape(len(delta), -1), axis=1, bitorder="little")


def _unpack(data: np.ndarray, width: int) -> np.ndarray:
    n = len(data)
    if width in (8, 16):
        return np.ascontiguousarray(data).view(f"<u{width // 8}").astype("<u4")
    size = 1 if width < 8 else 2 if width < 16 else 4
    bits = np.unpackbits(data, axis=1, bitorder="little")[:, :BLOCK * width].reshape(n * BLOCK, width)
    full = np.zeros((n * BLOCK, 8 * size), np.uint8)
    full[:, :width] = bits
    return np.packbits(full.ravel(), bitorder="little").view(f"<u{size}").reshape(n, BLOCK).astype("<u4")


def write_segment(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """Bytes of a segment: unsigned 32-bit ids of documents that have ``sizes`` ids each."""
    ids = np.asarray(ids, np.uint32)
    n = -(-len(ids) // BLOCK)
    grid = np.full(n * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    grid[:len(ids)] = ids
    grid = grid.reshape(n, BLOCK)
    low = grid.min(1) if n else np.zeros(0, np.uint32)
    delta = grid - low[:, None]
    width = _widths(np.partition(delta, int(BLOCK * PERCENTILE), axis=1)[:, int(BLOCK * PERCENTILE)]) if n else np.zeros(0, np.int64)
    odd = delta.astype(np.int64) >> width[:, None] > 0
    n_odd = odd.sum(1)
    packed: list[bytes] = [b""] * n
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        if w:
            for a in range(0, len(at), 1024):
                for k, row in zip(at[a:a + 1024], _pack(delta[at[a:a + 1024]], int(w)), strict=True):
                    packed[k] = row.tobytes()
    where, values = np.nonzero(odd)[1].astype("<u1"), delta[odd].astype("<u4")
    ends = np.cumsum(n_odd)
    blocks = [struct.pack("<IBH", int(low[k]), int(width[k]), int(n_odd[k])) + packed[k] + where[ends[k] - n_odd[k]:ends[k]].tobytes()
              + values[ends[k] - n_odd[k]:ends[k]].tobytes() for k in range(n)]
    starts = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    return _HEADER.pack(MAGIC, BLOCK, len(sizes), n, len(ids)) + np.asarray(sizes, "<u4").tobytes() + starts.tobytes() + b"".join(blocks)


def read_segment(data: bytes, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes) of a segment, or of its blocks first to last - 1, found by the index of block starts."""
    magic, block, docs, n, total = _HEADER.unpack_from(data)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a token segment")
    sizes = np.frombuffer(data, "<u4", docs, _HEADER.size)
    starts = np.frombuffer(data, "<u8", n + 1, _HEADER.size + 4 * docs).astype(np.int64)
    body = _HEADER.size + 4 * docs + 8 * (n + 1)
    last = n if last is None else min(last, n)
    raw = np.frombuffer(data, np.uint8)
    at = body + starts[first:last]
    if not len(at):
        return np.zeros(0, np.uint32), sizes
    head = raw[at[:, None] + np.arange(7)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4").ravel()
    width, n_odd = head[:, 4].astype(np.int64), np.ascontiguousarray(head[:, 5:7]).view("<u2").ravel().astype(np.int64)
    out = np.zeros((len(at), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        for a in range(0, len(rows), 1024):
            r = rows[a:a + 1024]
            out[r] = _unpack(raw[(at[r] + 7)[:, None] + np.arange(BLOCK * w // 8)], int(w))
    tail = at + 7 + BLOCK * width // 8
    rows = np.repeat(np.arange(len(at)), n_odd)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
    if len(rows):
        place = raw[tail[rows] + nth]
        out[rows, place] = np.ascontiguousarray(raw[(tail[rows] + n_odd[rows] + 4 * nth)[:, None] + np.arange(4)]).view("<u4").ravel()
    return (out + low[:, None]).ravel()[:max(0, min(total - first * BLOCK, (last - first) * BLOCK))], sizes


# ------------------------------------------------------------------ encoding
def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1 characters for themselves, the others get the
    code points from 256 on, in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder(dict):
    """Ids (little-endian 32-bit) of chunks, by the tokenizers library, in a bounded cache.

    The library's pre-tokens never run from a character that is no white space into one that is, nor from a letter into
    punctuation, so a text's ids are those of its chunks: white space, then what follows up to the next white space, cut before
    punctuation after letters.  A chunk of letters, with a blank before them or none, is one pre-token and goes to the library's model
    at once; all others go to the whole library.  For ASCII letters the pattern of chunks makes the cut, so that a word is kept once, whatever follows it."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)["model"]
        if spec.pop("type", None) == "BPE":  # the same model without its own cache: what is asked for is mostly new
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec.pop("merges")]
            self.model = BPE(spec.pop("vocab"), merges, cache_capacity=0, **{k: v for k, v in spec.items() if v})
        self.letters = byte_letters()
        self.blank = self.letters[ord(" ")]
        self.old: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        out = self.old.get(chunk)
        if out is not None:
            return self._keep(chunk, out)
        head = _HEAD.match(chunk) if not chunk.isascii() else None
        word = chunk[1:] if chunk[:1] == " " else chunk
        if word.isalpha():
            if not chunk.isascii():
                word = chunk.encode().decode("latin-1").translate(self.letters)
            elif word is not chunk:  # these letters stand for themselves
                word = self.blank + word
            ids = [t.id for t in self.model.tokenize(word)]
            return self._keep(chunk, _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids))
        if head:
            return self._keep(chunk, self[chunk[:head.end()]] + self[chunk[head.end():]])
        if chunk[:1] in "\n\t" and chunk[1:].isalpha():
            return self._keep(chunk, self[chunk[0]] + self[chunk[1:]])
        ids = self.lib.encode(chunk, add_special_tokens=False).ids
        return self._keep(chunk, struct.pack(f"<{len(ids)}I", *ids))

    def _keep(self, chunk: str, out: bytes) -> bytes:
        """Two generations: what was used lately outlives the next turnover."""
        if len(chunk) <= 64:
            if len(self) >= CACHE_CHUNKS:
                self.old = dict(self)
                self.clear()
            self[chunk] = out
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, without the end id."""
        get = self.__getitem__
        return [b"" if not t else b"".join(map(get, _CHUNK.findall(t) if not _WHOLE.search(t) else [t])) for t in texts]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ------------------------------------------------------------------ Spark
def write(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all texts and write the segments; returns the written table (part, seg, n_docs, n_ids, doc_ids, data)."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        part, seg, end = TaskContext.get().partitionId(), 0, np.asarray([END], "<u4").tobytes()
        ids, held, total = [], [], 0

        def segment():
            flat = np.frombuffer(b"".join(held), "<u4")
            sizes = np.asarray([len(h) // 4 for h in held], np.int64)
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([len(flat)], pa.int64()),
                                    pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)), pa.array([write_segment(flat, sizes)], pa.binary())],
                                   ["part", "seg", "n_docs", "n_ids", "doc_ids", "data"])

        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in slices([len(t or "") for t in texts], 2 << 20):
                for k, x in enumerate(_encoder(path).encode(texts[i:j]), i):
                    held.append(x + end)
                    ids.append(b.column(0).slice(k, 1))
                    total += len(x) // 4 + 1
                    if total >= SEGMENT_IDS:
                        yield segment()
                        ids, held, total, seg = [], [], 0, seg + 1
        if held:
            yield segment()

    order = [F.col("id").asc_nulls_first(), F.col("h")]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h")).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.select("id", "text").mapInArrow(run, f"part int, seg int, n_docs long, n_ids long, doc_ids array<{kind}>, data binary"), "token-files")


def read(files: DataFrame) -> DataFrame:
    """Decode the files: doc_id, start, n_tokens, ids_crc32 of every document."""
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seg")) - F.col("n_ids")
    starts = files.select("part", "seg", "n_ids").withColumn("inside", inside).join(base, "part").select("part", "seg", (F.col("base") + F.col("inside")).alias("start"))
    starts = stored(starts, "token-starts")  # small and of known size, so that the segments themselves need no shuffle
    kind = dict(files.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                ids, sizes = read_segment(b.column("data")[r].as_py())
                ends = np.cumsum(sizes, dtype=np.int64)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.record_batch([b.column("doc_ids")[r].values, pa.array(b.column("start")[r].as_py() + ends - sizes), pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("part", "seg", "doc_ids", "data").join(starts, ["part", "seg"]).mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
