"""Passages that stand in an earlier document, found with suffix arrays of shards and cut out.

A window is ``WINDOW`` bytes that lie in one document.  A byte goes if a window over it also starts in a document with a smaller
id.  Windows that are equal must meet in one shard, so each goes where its smallest k-gram hash (of ``GRAM`` bytes) leads:
neighbours mostly share it, and a run of them is sent once, as one region of text.  A slice of documents sends equal regions once, from
its first document (in the others they are repeats already); copies of a passage therefore cost a shard one region a slice.

A shard takes the regions of each hash that comes from two documents or more, keeps equal ones once (the first document's stands for all), leaves out those that can't
share a window with another (`_may_share`), sorts the suffixes of the joined bytes of those that differ by induced sorting (`suffixes`), and computes the permuted common prefixes.  Neighbours in the suffix array with ``WINDOW``
common bytes are one group; a window of a later document than the group's first is a repeat.  Hashes only choose where windows
meet: equal regions are compared as bytes.

Repeats come back as (document, start, number of windows).  Documents without any (a fixed bitmap of ids tells) are finished where they are read; the
others are joined with their repeats.

Defined results: null texts count as empty, texts under ``WINDOW`` bytes lose nothing.  Rows of the same id never take bytes from each other (each
keeps its row; equal ids with different texts are kept apart by a text hash); a null id counts as later than all others.  Matches
are judged on the input bytes.  Empty tables give no rows; other columns are not read.  Texts are compared whole: a
long text is worked on in overlapping pieces of ``PIECE`` bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transcript_quality.llm.common import forget_shuffles, id_bit, id_bitmap, released, run_starts, slices, stored
from transcript_quality.llm.suffixes import permuted_common_prefixes, suffix_array, words8

WINDOW = 50
GRAM = 16
#: Bytes hashed at a time; bytes of a slice that are packed together; bytes whose suffixes are sorted together.
PIECE = 1 << 19
SLICE = 6 << 20
SORTED = 1 << 18
#: Packed bytes of a batch of rows on their way to the shards.
SENT = 1 << 20
#: Region bytes of a shard, roughly.
SHARD = 12 << 20
#: A region's hash travels with so many bytes; more regions than equal ones may share them, which only makes them meet.
NAME_BYTES = 3
LAST = (1 << 63) - 1
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def regions(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same smallest hash: (hash, text number, start, number of windows)."""
    out = []
    long = [(i, a) for i, t in enumerate(texts) for a in range(0, max(1, len(t) - window + 1), PIECE)]
    sizes = [min(len(texts[i]) - a, PIECE + window - 1) for i, a in long]
    for lo, hi in slices(sizes, PIECE):
        which, at, size = np.asarray([i for i, _ in long[lo:hi]]), np.asarray([a for _, a in long[lo:hi]]), np.asarray(sizes[lo:hi])
        joined = b"".join(texts[i][a:a + n] for (i, a), n in zip(long[lo:hi], sizes[lo:hi], strict=True))
        if len(joined) < window:
            continue
        w = words8(np.frombuffer(joined, np.uint8))
        low = mix(mix(w[:len(joined) - GRAM + 1]) * _C ^ w[GRAM - 8:len(joined) - 7])
        span, need = 1, window - GRAM + 1
        while span < need:
            step = min(span, need - span)
            low = np.minimum(low[:-step], low[step:])
            span += step
        ends = np.cumsum(size)
        piece = np.repeat(np.arange(len(size)), size)[:len(low)]
        inside = np.arange(len(low)) + window <= ends[piece]
        start = np.flatnonzero(inside & np.append(True, (low[1:] != low[:-1]) | (piece[1:] != piece[:-1])))
        if not len(start):
            continue
        p = piece[start]
        n = np.minimum(np.append(start[1:], len(low)), ends[p] - window + 1) - start
        out.append((low[start], which[p], at[p] + start - (ends - size)[p], n))
    if not out:
        return tuple(np.zeros(0, k) for k in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _merged(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that follow each other in a document as one."""
    order = np.lexsort((start, doc))
    doc, start, n = doc[order], start[order], n[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + n[:-1])) if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return doc[first], start[first], np.add.reduceat(n, first) if len(first) else n


def _send(texts: list[bytes], ids: np.ndarray, keys: np.ndarray, shards: int):
    """The slice's regions, packed for each shard, and the repeats inside the slice as (document, start, windows)."""
    order = sorted(range(len(texts)), key=lambda i: (ids[i], keys[i]))
    texts, ids, keys = [texts[i] for i in order], ids[order], keys[order]
    h, doc, start, n = regions(texts)  # in the order of ids and starts
    by = np.argsort(h, kind="stable")
    heads = run_starts(h[by])
    several = np.repeat(ids[doc[by[heads]]] != ids[doc[by[np.append(heads[1:], len(h)) - 1]]], np.diff(np.append(heads, len(h)))) if len(h) else np.zeros(0, bool)
    seen: dict[bytes, int] = {}
    again, last = [], -1
    for x in by[several].tolist():
        if h[x] != last:
            seen, last = {}, h[x]
        d, s = doc[x], start[x]
        first = seen.setdefault(texts[d][s:s + n[x] + WINDOW - 1], ids[d])
        if first < ids[d]:
            again.append(x)
    inner = _merged(doc[again], start[again], n[again])
    keep = np.ones(len(h), bool)
    keep[again] = False
    h, doc, start, n = h[keep], doc[keep], start[keep], n[keep]
    spread = mix(h + np.uint64(1))
    shard = (spread % np.uint64(shards)).astype(np.int64)
    by = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
    cuts = np.append(run_starts(shard[by]), len(by))
    # what all shards need is computed for all at once: at many shards a slice has few regions for each
    d, spread, start, n = doc[by], spread[by], start[by], n[by]
    new = np.ones(len(by), bool)
    new[1:] = d[1:] != d[:-1]
    new[cuts[:-1]] = True
    first = np.zeros(len(by), bool)
    first[cuts[:-1]] = True
    gap = np.where(new, start, np.diff(start, prepend=0))
    numbers = np.stack([(spread >> np.uint64(64 - 8 * NAME_BYTES)).astype("<i8"), (new & ~first).astype("<i8"), gap.astype("<i8"), n.astype("<i8")]).view(np.uint8).reshape(4, len(by), 8)
    owner = d[new]
    own_ids, own_keys, own_cuts = ids[owner], keys[owner], np.append(0, np.cumsum(new))[cuts].tolist()
    parts = list(zip(d.tolist(), start.tolist(), (start + n + WINDOW - 1).tolist(), strict=True))
    pack = zstandard.ZstdCompressor(level=3)
    packed = []
    for s, a, b, x, y in zip(shard[by[cuts[:-1]]].tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), own_cuts[:-1], own_cuts[1:], strict=True):
        body = b"".join([texts[i][p:q] for i, p, q in parts[a:b]])
        # numbers byte by byte: all first bytes, all second bytes ...; the zeros of small numbers then lie together
        meta = numbers[0, a:b, :NAME_BYTES].T.tobytes() + numbers[1:, a:b].transpose(0, 2, 1).tobytes() + own_ids[x:y].tobytes() + own_keys[x:y].tobytes()
        packed.append((s, b - a, y - x, pack.compress(meta), pack.compress(body)))
    return packed, (ids[inner[0]], keys[inner[0]], inner[1], inner[2])


def _unpack(rows: list[tuple]):
    """Arrays of all regions of a shard: hash, id, key, start, windows, offset of the text, and the joined texts."""
    un, parts, bodies = zstandard.ZstdDecompressor(), [], []
    for n, docs, meta, body in rows:
        raw, at = un.decompress(meta), n * (NAME_BYTES + 24)
        numbers = np.zeros((4, n, 8), np.uint8)
        numbers[0, :, :NAME_BYTES] = np.frombuffer(raw, np.uint8, n * NAME_BYTES).reshape(NAME_BYTES, n).T
        numbers[1:] = np.frombuffer(raw, np.uint8, n * 24, n * NAME_BYTES).reshape(3, 8, n).transpose(0, 2, 1)
        name, doc, gap, count = numbers.view("<i8")[:, :, 0]
        doc = np.cumsum(doc)
        far = np.cumsum(gap)
        first = np.diff(doc, prepend=-1) != 0
        start = far - np.repeat((far - gap)[first], np.diff(np.append(np.flatnonzero(first), n)))
        ids, keys = np.frombuffer(raw, np.int64, docs, at), np.frombuffer(raw, np.int64, docs, at + 8 * docs)
        parts.append((name, ids[doc], keys[doc], start, count))
        bodies.append(un.decompress(body))
    h, ids, keys, start, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    size = n + WINDOW - 1
    return h, ids, keys, start, n, np.cumsum(size) - size, b"".join(bodies)


def later_windows(texts: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    """For each text, whether each of its windows also starts in a text of a smaller id: by the suffix array of all the texts."""
    size = np.asarray([len(x) for x in texts])
    t = np.frombuffer(b"".join(texts), np.uint8)
    sa = suffix_array(t)
    far = permuted_common_prefixes(t, sa, WINDOW)
    group = np.cumsum(far[sa] < WINDOW)
    owner = np.repeat(np.arange(len(texts)), size)
    whole = np.arange(len(t)) + WINDOW <= np.cumsum(size)[owner]
    sa, group = sa[whole[sa]], group[whole[sa]]
    heads = run_starts(group)
    least = np.repeat(np.minimum.reduceat(ids[owner[sa]], heads), np.diff(np.append(heads, len(sa)))) if len(sa) else np.zeros(0, np.int64)
    later = np.zeros(len(t), bool)
    later[sa] = ids[owner[sa]] > least
    ends = np.cumsum(size)
    return [later[e - n:max(e - n, e - WINDOW + 1)] for e, n in zip(ends.tolist(), size.tolist(), strict=True)]


def _groups_of_texts(sizes: np.ndarray, key: np.ndarray):
    """Ranges of rows of about SORTED bytes that never cut a key's rows."""
    heads = np.append(run_starts(key), len(key))
    total = np.append(0, np.cumsum(sizes))
    a = 0
    while a < len(heads) - 1:
        b = max(a + 1, int(np.searchsorted(total[heads], total[heads[a]] + SORTED, side="right")) - 1)
        yield int(heads[a]), int(heads[b])
        a = b


def _split(texts: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    """later_windows of one hash's regions.  Where they are too many to be sorted together, windows are dealt by a hash of their own bytes and
    sorted share by share; equal windows are in the same share."""
    total = sum(map(len, texts))
    if total <= 16 * SORTED:
        return later_windows(texts, ids)
    out = [np.zeros(len(x) - WINDOW + 1, bool) for x in texts]
    shares = 2 + total * 3 // SORTED
    dealt = []
    for x in texts:
        w = words8(np.frombuffer(x, np.uint8))
        n, v = len(x) - WINDOW + 1, np.uint64(0)
        for k in (0, 8, 16, 24, 32, 40, 42):
            v = mix((v ^ w[k:k + n]) * _C)
        dealt.append((v % np.uint64(shares)).astype(np.int32))
    for s in range(shares):
        which = [(i, int(p)) for i, d in enumerate(dealt) for p in np.flatnonzero(d == s)]
        if which:
            hit = later_windows([texts[i][p:p + WINDOW] for i, p in which], ids[[i for i, _ in which]])
            for (i, p), y in zip(which, hit, strict=True):
                out[i][p] = y[0]
    return out


def _may_share(texts: list[bytes]) -> np.ndarray:
    """Whether each region may share a window with another one.  All windows of a region hold its gram of the smallest hash.  Equal windows hold it in the same place,
    so at least half of their other bytes are equal before it or after it: regions that have neither half in common with another are alone."""
    size = np.asarray([len(x) for x in texts])
    ends = np.cumsum(size)
    t = np.frombuffer(b"".join(texts), np.uint8)
    w = words8(t)
    low = mix(mix(w[:len(t) - GRAM + 1]) * _C ^ w[GRAM - 8:len(t) - 7])
    for k in range(1, GRAM):  # grams that reach into the next region
        low[(ends[:-1] - k)] = ~np.uint64(0)
    starts = ends - size
    least = np.minimum.reduceat(low, starts)
    at = np.flatnonzero(low == np.repeat(least, size)[:len(low)])
    own, half = np.searchsorted(ends, at, side="right"), (WINDOW - GRAM + 1) // 2
    out = np.zeros(len(texts), bool)
    for first, inside in ((at - half, at - half >= starts[own]), (at + GRAM, at + GRAM + half <= ends[own])):
        who, p, key = own[inside], first[inside], least[own[inside]]
        for k in (*range(0, half - 7, 8), half - 8):
            key = mix((key ^ w[p + k]) * _C)
        order = np.lexsort((who, key))
        who, key = who[order], key[order]
        heads = run_starts(key)
        if len(heads):
            last = np.append(heads[1:], len(key))
            out[who[np.repeat(who[heads] != who[last - 1], last - heads)]] = True
    return out


def _judge(rows: list[tuple]):
    """A shard's repeats: (id, key, start, windows)."""
    h, ids, keys, start, n, at, body = _unpack(rows)
    by = np.lexsort((start, keys, ids, h))
    h, ids, keys, start, n, at = (c[by] for c in (h, ids, keys, start, n, at))
    heads = run_starts(h)
    several = np.repeat(ids[heads] != ids[np.append(heads[1:], len(h)) - 1], np.diff(np.append(heads, len(h))))
    h, ids, keys, start, n, at = (c[several] for c in (h, ids, keys, start, n, at))
    if not len(h):
        return None
    # equal regions once: the first stands for all, those of later documents are repeats as they are
    first, own, rep = {}, [], np.zeros(len(h), np.int64)
    for x, (k, a, m) in enumerate(zip(h.tolist(), at.tolist(), (n + WINDOW - 1).tolist(), strict=True)):
        text = (k, body[a:a + m])
        if text not in first:
            first[text] = len(own)
            own.append(x)
        rep[x] = first[text]
    own = np.asarray(own)
    copy = ids > ids[own[rep]]
    found = [(ids[copy], keys[copy], start[copy], n[copy])]
    # a hash with one region left has no other text to be compared with
    heads = run_starts(h[own])
    sort = np.flatnonzero(np.repeat(np.diff(np.append(heads, len(own))) > 1, np.diff(np.append(heads, len(own)))))
    texts = [body[a:a + m] for a, m in zip(at[own[sort]].tolist(), (n[own[sort]] + WINDOW - 1).tolist(), strict=True)]
    if texts:
        sort = sort[_may_share(texts)]
        texts = [body[a:a + m] for a, m in zip(at[own[sort]].tolist(), (n[own[sort]] + WINDOW - 1).tolist(), strict=True)]
    later = [np.zeros(m, bool) for m in n[own].tolist()]
    for a, b in _groups_of_texts(n[own[sort]] + WINDOW - 1, h[own[sort]]):
        x = own[sort[a:b]]
        for i, y in zip(sort[a:b].tolist(), (_split if h[x[0]] == h[x[-1]] else later_windows)(texts[a:b], ids[x]), strict=True):
            later[i] = y
    own_size = np.asarray([len(x) for x in later])
    flat = np.concatenate(later) if later else np.zeros(0, bool)
    offset = np.cumsum(own_size) - own_size
    edge = np.diff(np.concatenate([[0], flat.astype(np.int8), [0]]))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    o = np.searchsorted(offset, a, side="right") - 1
    while len(a):  # a run that goes on into the next region is cut there
        end = np.minimum(b, offset[o] + own_size[o])
        mine = np.flatnonzero(~copy)
        back = mine[np.argsort(rep[mine], kind="stable")]
        lo, hi = np.searchsorted(rep[back], o), np.searchsorted(rep[back], o, side="right")
        x = np.repeat(np.arange(len(a)), hi - lo)
        to = back[np.arange(len(x)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)]
        found.append((ids[to], keys[to], start[to] + (a - offset[o])[x], (end - a)[x]))
        more = end < b
        a, b, o = end[more], b[more], o[more] + 1
    ids, keys, start, n = (np.concatenate(c) for c in zip(*found, strict=True))
    if not len(ids):
        return None
    doc = np.lexsort((start, keys, ids))
    ids, keys, start, n = ids[doc], keys[doc], start[doc], n[doc]
    new = run_starts(ids, keys)
    number = np.zeros(len(ids), np.int64)
    number[new] = 1
    d, start, n = _merged(np.cumsum(number) - 1, start, n)
    return ids[new[d]], keys[new[d]], start, n


#: Repeats of one row on their way.
THROUGH = 1 << 14
_FOUND = "id long, key long, start long, n long"


def _found(cols) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.asarray(c, np.int64)) for c in cols], ["id", "key", "start", "n"])


def repeated_windows(docs: DataFrame) -> DataFrame:
    """docs (id, key, t) -> (id, key, start, n): n windows from start on also start in a document of a smaller id."""
    total = docs.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    partitions = max(1, -(-total * 4 // (2 * SHARD)))  # regions overlap: they hold about four times the text
    shards = 2 * partitions

    def send(batches):
        for b in batches:
            for lo, hi in slices(pc.binary_length(b.column(2)).to_pylist(), SLICE):
                texts = b.column(2).slice(lo, hi - lo).to_pylist()
                packed, (i, key, start, n) = _send(texts, b.column(0).to_numpy()[lo:hi], b.column(1).to_numpy()[lo:hi], shards)
                # repeats found here already go through as rows of any shard
                for a in range(0, len(i), THROUGH):
                    c = slice(a, a + THROUGH)
                    packed.append((int(i[a] % shards), -len(i[c]), 0, b"".join(x[c].astype(np.int64).tobytes() for x in (i, key, start, n)), b""))
                for a, e in slices([len(row[3]) + len(row[4]) for row in packed], SENT):
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*packed[a:e], strict=True), sent.types, strict=True)], schema=sent)

    sent = pa.schema([("shard", pa.int64()), ("k", pa.int64()), ("d", pa.int64()), ("meta", pa.binary()), ("body", pa.binary())])

    def judge(batches):
        rows, shard = [], None
        for b in batches:
            for s, *row in (tuple(x.as_py() for x in r) for r in zip(*b.columns, strict=True)):
                if row[0] < 0:
                    yield _found(np.frombuffer(row[2], np.int64).reshape(4, -1))
                    continue
                if s != shard and rows:
                    if out := _judge(rows):
                        yield _found(out)
                    rows = []
                shard = s
                rows.append(row)
        if rows and (out := _judge(rows)):
            yield _found(out)

    return stored(docs.select("id", "key", "t").mapInArrow(released(send), "shard long, k long, d long, meta binary, body binary").repartition(partitions, "shard")
                  .sortWithinPartitions("shard").mapInArrow(released(judge), _FOUND), "repeats")


def _cut(text: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs, and what is left."""
    if not len(starts):
        return 0, 0, text
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate((starts + sizes + WINDOW - 1)[order])
    head = np.flatnonzero(np.append(True, a[1:] > b[:-1]))
    a, b = a[head], np.append(b[head[1:] - 1], b[-1])
    keep = [text[x:y] for x, y in zip(np.append(0, b).tolist(), np.append(a, len(text)).tolist(), strict=True)]
    return int((b - a).sum()), len(a), b"".join(keep)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, and ``kept`` (the bytes that are left)."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("t"))
    rows = rows.withColumn("key", F.xxhash64("t"))
    found = repeated_windows(rows)
    forget_shuffles(docs.sparkSession)  # the regions
    shared = docs.sparkSession.sparkContext.broadcast(id_bitmap(found.select("id").distinct()))

    @F.arrow_udf("boolean")
    def bitmap_test(at: pa.Array) -> pa.Array:
        x = at.to_numpy()
        return pa.array((shared.value[x >> 3] >> (x & 7).astype(np.uint8) & 1).astype(bool))

    asked = rows.withColumn("hit", bitmap_test(id_bit("id")))
    spans = found.groupBy("id", "key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    hit = asked.where("hit").join(spans, ["id", "key"], "left").select("doc_id", "t", F.col("spans.start").alias("s"), F.col("spans.n").alias("n"))
    free = asked.where("not hit").select("doc_id", "t", F.lit(None).cast("array<long>").alias("s"), F.lit(None).cast("array<long>").alias("n"))

    def run(batches):
        for b in batches:
            for lo, hi in slices(pc.binary_length(b.column(1)).to_pylist()):
                part, out = b.slice(lo, hi - lo), []
                for t, s, n in zip(*part.columns[1:], strict=True):
                    t = t.as_py()
                    at = (c.values.to_numpy() if c.is_valid else np.zeros(0, np.int64) for c in (s, n))
                    out.append((len(t), *_cut(t, *at)))
                size, gone, runs, kept = zip(*out, strict=True)
                yield pa.record_batch([part.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                                      ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return hit.unionByName(free).mapInArrow(released(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(cut: DataFrame) -> DataFrame:
    """The result with kept_sha256 in place of the bytes."""
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
