"""Suffix arrays of byte strings by induced sorting, and permuted common prefixes.

Suffixes are classified (smaller or larger than their follower), the leftmost-smaller substrings are sorted by one induction,
named, and, where names repeat, the string of names is sorted by recursion; a last induction gives all suffixes.  Over bytes an
induction goes letter by letter with whole numpy arrays (a bucket's suffixes are read at once; runs of one letter come in
waves); over the names of a recursion the chains from a suffix to the next leftmost-smaller one are followed by doubling."""

from __future__ import annotations

import numpy as np

def words8(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one little-endian number (zeros follow the end)."""
    raw = t.tobytes() + bytes(8)
    return np.ndarray((len(t) + 1,), "<u8", raw, strides=(1,)).copy()


def _smaller(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a place later (the end is smallest)."""
    ends = np.append(np.flatnonzero(t[1:] != t[:-1]), len(t) - 1)
    up = np.zeros(len(ends), bool)
    up[:-1] = t[ends[:-1]] < t[ends[:-1] + 1]
    return np.repeat(up, np.diff(np.append(-1, ends)))


def _scatter(sa: np.ndarray, at: np.ndarray, letters: np.ndarray, place: np.ndarray, step: int) -> None:
    """Write suffixes at their buckets' next places, upward or downward, in the given order."""
    count = np.bincount(letters, minlength=len(place))
    order = np.argsort(letters, kind="stable")
    sorted_letters = letters[order]
    rank = np.arange(len(order)) - (np.cumsum(count) - count)[sorted_letters]
    sa[place[sorted_letters] + rank if step > 0 else place[sorted_letters] - 1 - rank] = at[order]
    place += step * count


def _induce_letters(t: np.ndarray, lms: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    n, sa = len(t), np.zeros(len(t), np.int64)
    present = np.flatnonzero(last > first)
    cut = np.searchsorted(t[lms], np.arange(len(first) + 1))
    head = first.copy()
    sa[head[t[n - 1]]] = n - 1
    head[t[n - 1]] += 1
    for c in present:
        a = done = first[c]
        while head[c] > done:  # suffixes before those of the last wave that start with the same letter
            wave = sa[done:head[c]]
            done = head[c]
            before = wave[wave > 0] - 1
            before = before[t[before] == c]
            sa[done:done + len(before)] = before
            head[c] += len(before)
        before = np.concatenate([sa[a:head[c]], lms[cut[c]:cut[c + 1]]])
        before = before[before > 0] - 1
        before = before[t[before] > c]
        _scatter(sa, before, t[before], head, 1)
    tail = last.copy()
    for c in present[::-1]:
        done = last[c]
        while tail[c] < done:
            wave = sa[tail[c]:done][::-1]
            done = tail[c]
            before = wave[wave > 0] - 1
            before = before[t[before] == c]
            tail[c] -= len(before)
            sa[tail[c]:done] = before[::-1]
        before = np.concatenate([sa[tail[c]:last[c]][::-1], sa[first[c]:head[c]][::-1]])
        before = before[before > 0] - 1
        before = before[t[before] < c]
        _scatter(sa, before, t[before], tail, -1)
    return sa


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks: 0 for the smallest key (keys are not negative)."""
    n, out = len(keys), np.zeros(len(keys), np.int64)
    bits = max(1, (n - 1).bit_length())
    if n and int(keys.max()).bit_length() + bits < 64:  # sorting numbers is several times faster than sorting their places
        both = np.sort(keys << bits | np.arange(n))
        order, keys = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(keys)
        keys = keys[order]
    out[order[1:]] = np.cumsum(keys[1:] != keys[:-1])
    return out


def _induce_names(t: np.ndarray, lms: np.ndarray, rank: np.ndarray | None) -> np.ndarray:
    """Ranks of all suffixes by their names up to the next leftmost-smaller suffix, and by that one's ``rank`` (None: by its name alone).

    A suffix reaches the next leftmost-smaller one by a chain of followers; the chains are followed by doubling.  A name's
    class goes before what comes later: at the same name a suffix larger than its follower is smaller."""
    m, here = len(t), np.arange(len(t))
    kind = 2 * t + _smaller(t)
    of_lms = np.bincount(kind[lms], minlength=int(kind.max()) + 1)
    fewer = np.cumsum(of_lms) - of_lms  # leftmost-smaller suffixes of smaller kinds
    known = np.zeros(m + 1, np.int64)
    known[lms] = fewer[kind[lms]] if rank is None else rank
    end = np.append(lms, m)[np.searchsorted(lms, here, side="right")]
    r, h, longest = (np.cumsum(np.bincount(kind) > 0) - 1)[kind], 1, int((end - here).max())
    one = np.zeros(m, np.int64)
    while h <= longest:
        one[r] = here
        upto = np.cumsum(np.bincount(kind[one[:int(r.max()) + 1]], minlength=len(fewer)))  # ranks of kinds up to each
        far = here + h
        to = np.minimum(far, np.minimum(end, m - 1))
        k = kind[to]
        then = 1 + np.where(far < end, r[to] + fewer[k], known[to] + upto[k])
        then[(far > end) | (far >= m)] = 0  # nothing follows, or it is in the rank already
        r = _ranks(r * (2 * m + 2) + then)
        h *= 2
    return r


def _same_substrings(t: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the size bytes from a and from b are equal."""
    w, same = words8(t), np.ones(len(a), bool)
    alive, k = np.arange(len(a)), 0
    while len(alive):
        short = np.maximum(0, 8 - (size[alive] - k)).astype(np.uint64)
        x = (w[a[alive] + k] ^ w[b[alive] + k]) << (short * np.uint64(8))
        same[alive[x != 0]] = False
        k += 8
        alive = alive[(x == 0) & (size[alive] > k)]
    return same


def _leftmost(t: np.ndarray) -> np.ndarray:
    small = _smaller(t)
    return np.flatnonzero(small[1:] & ~small[:-1]) + 1


def _name_ranks(t: np.ndarray) -> np.ndarray:
    """Rank of each suffix of a string of names (no two suffixes are equal)."""
    if len(t) < 2:
        return np.zeros(len(t), np.int64)
    lms = _leftmost(t)
    names = _ranks(_induce_names(t, lms, None)[lms])
    if len(lms) and names.max() + 1 < len(lms):
        names = _name_ranks(names)
    return _induce_names(t, lms, names)


def suffix_array(t: np.ndarray) -> np.ndarray:
    """The starts of all suffixes of the bytes t in ascending order."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    last = np.cumsum(np.bincount(t, minlength=256))
    first = np.append(0, last[:-1])
    lms = _leftmost(t)
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        sa = _induce_letters(t, lms[np.argsort(t[lms], kind="stable")], first, last)
        order = sa[is_lms[sa]]
        size = np.zeros(n, np.int64)
        size[lms[:-1]] = np.diff(lms) + 1  # the last one reaches the end and equals no other
        a, b = order[:-1], order[1:]
        new = (size[a] != size[b]) | (size[a] == 0)
        rest = np.flatnonzero(~new)
        new[rest] = ~_same_substrings(t, a[rest], b[rest], size[a[rest]])
        if not new.all():
            name = np.zeros(n, np.int64)
            name[order] = np.concatenate([[0], np.cumsum(new)])
            order = lms[np.argsort(_name_ranks(name[lms]))]
        lms = order
    return _induce_letters(t, lms, first, last)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For each suffix, in text order, how many bytes (``limit`` at most) it shares with the suffix before it in the array."""
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    w, out = words8(t), np.zeros(n, np.int64)
    alive = np.flatnonzero(before >= 0)
    for k in range(0, limit, 8):
        a, b = alive + k, before[alive] + k
        x = w[np.minimum(a, n)] ^ w[np.minimum(b, n)]
        out[alive] += np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> np.uint8(3))
        alive = alive[x == 0]
    left = n - np.maximum(np.arange(n), before)
    return np.minimum(np.minimum(out, left), limit)
