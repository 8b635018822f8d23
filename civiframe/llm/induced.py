"""Suffix and common-prefix arrays by induced sorting with disk-backed queues.

The suffixes that start a rise of the text (S*) are named and sorted by repeated pairing of
their names. From them the falling (L) and then the rising (S) suffixes are induced: the
suffixes are taken in order from a priority queue by first character, and each one's
predecessor goes back into the queue. A queue entry is a suffix and the length of the
prefix it shares with the one before; that of an induced pair is one more than the least of
those between their sources. Whole queue levels are handled as arrays, and entries beyond
a memory bound wait in a temporary file of the task, which is gone when it ends.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BUCKETS = 256


class BucketQueue:
    """Suffix tuples (place, shared prefix) by first character, first in first out in each."""

    def __init__(self, memory: int):
        self.memory, self.held = memory, 0
        self.parts: list[list] = [[] for _ in range(BUCKETS)]
        self.file = None

    def push(self, bucket: int, place: np.ndarray, lcp: np.ndarray) -> None:
        self.parts[bucket].append((place, lcp))
        self.held += place.nbytes + lcp.nbytes
        if self.held > self.memory:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for k, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(part[0].tobytes() + part[1].tobytes())
                    parts[k] = (at, len(part[0]))
        self.held = 0

    def _read(self, part: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(part[0], np.ndarray):
            self.held -= part[0].nbytes + part[1].nbytes
            return part
        at, n = part
        self.file.seek(at)
        raw = self.file.read(n * 6)
        return np.frombuffer(raw, np.int32, n), np.frombuffer(raw, np.uint16, n, 4 * n)

    def pop(self, bucket: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Everything in the bucket, also what is pushed to it meanwhile."""
        while self.parts[bucket]:
            parts, self.parts[bucket] = self.parts[bucket], []
            read = [self._read(p) for p in parts]
            yield np.concatenate([r[0] for r in read]), np.concatenate([r[1] for r in read])


def rising(text: np.ndarray) -> np.ndarray:
    """True for S suffixes: smaller than the one that follows. The last is one."""
    n = len(text)
    out = np.ones(n, bool)
    change = np.nonzero(text[:-1] != text[1:])[0]
    following = np.searchsorted(change, np.arange(n - 1))
    inside = following < len(change)
    at = change[following[inside]]
    out[:-1][inside] = text[at] < text[at + 1]
    return out


def _words(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on as one number, first byte highest."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(text)]
    return out


def sorted_starts(text: np.ndarray, words: np.ndarray, starts: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """The S* suffixes in order, and the prefix that each shares with the one before, to ``cap``."""
    m = len(starts)
    ends = np.append(starts[1:], starts[-1])  # a name runs to the next start, inclusive
    lengths = np.minimum(ends - starts + 1, cap + 8)
    # names: eight bytes at a time; what lies behind the end counts as highest (the longer one falls there)
    name = np.zeros(m, np.int64)
    open_ = np.arange(m)
    offset = 0
    while len(open_):
        at = np.minimum(starts[open_] + offset, len(text) - 1)
        left = np.clip(lengths[open_] - offset, 0, 8)
        key = words[at]
        shift = (8 * (8 - left)).astype(np.uint64)
        high = np.where(left == 0, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(shift, np.uint64(63))) - np.uint64(1))
        key = np.where(left == 0, high, key | np.where(left < 8, high, np.uint64(0)))
        key[open_ == m - 1] = 0  # the end of the text is smallest
        order = np.lexsort((key, name[open_]))
        own, key_s = name[open_][order], key[order]
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (key_s[1:] != key_s[:-1])])
        group_start = np.concatenate([[True], own[1:] != own[:-1]])
        # names keep their order: old name plus the place of the new group within the old one
        place = np.arange(len(order))
        name[open_[order]] = own + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(group_start, place, 0))
        offset += 8
        sizes = np.diff(np.append(np.nonzero(fresh)[0], len(order)))
        tied = np.repeat(sizes > 1, sizes)
        again = open_[order][tied]
        open_ = again[lengths[again] > offset]
    levels = [np.unique(name, return_inverse=True)[1].astype(np.int32)]
    span = 1
    while levels[-1].max() + 1 < m:
        rank = levels[-1]
        reach = np.append(starts, np.full(span, len(text) + cap))[span : span + m] - starts
        counts = np.bincount(rank)
        if (reach[counts[rank] > 1] >= cap).all():
            break  # ties share as much as matters
        after = np.zeros(m, np.int64)
        after[: m - span] = rank[span:] + 1 if span < m else 0
        levels.append(np.unique(rank.astype(np.int64) * (m + 2) + after, return_inverse=True)[1].astype(np.int32))
        span *= 2
        if span >= m:
            break
    order = np.argsort(levels[-1], kind="stable")
    lcp = np.zeros(m, np.uint16)
    if m > 1:
        i, j = order[:-1].copy(), order[1:].copy()
        for k in range(len(levels) - 1, -1, -1):
            padded = np.append(levels[k], [-1])
            same = (padded[np.minimum(i, m)] == padded[np.minimum(j, m)]) & (i < m) & (j < m)
            # an end of the text behind the last start ends what is shared
            same &= (i + (1 << k) < m) & (j + (1 << k) < m)
            i, j = i + (same << k), j + (same << k)
        shared = starts[i] - starts[order[:-1]]
        lcp[1:] = extend(text, words, starts[order[:-1]], starts[order[1:]], shared, cap)
    return starts[order], lcp


def extend(text: np.ndarray, words: np.ndarray, a: np.ndarray, b: np.ndarray, shared: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix at places a and b, of which ``shared`` is known, to ``cap``."""
    shared = np.minimum(shared, cap).astype(np.int64)
    open_ = np.nonzero(shared < cap)[0]
    last = len(text) - 1
    while len(open_):
        x, y = a[open_] + shared[open_], b[open_] + shared[open_]
        inside = (x <= last) & (y <= last)
        differ = np.where(inside, words[np.minimum(x, last)] ^ words[np.minimum(y, last)], np.uint64(1) << np.uint64(63))
        equal = np.full(len(open_), 8)
        some = differ != 0
        bits = np.frexp((differ[some] >> np.uint64(11)).astype(np.float64))[1] + 11
        bits = np.where(differ[some] >> np.uint64(11) == 0, np.frexp((differ[some] & np.uint64(0x7FF)).astype(np.float64))[1], bits)
        equal[some] = (64 - bits) // 8
        room = last + 1 - np.maximum(x, y)
        equal = np.where(inside, np.minimum(equal, np.maximum(room, 0)), 0)
        shared[open_] += equal
        open_ = open_[(equal == 8) & (shared[open_] < cap)]
    return np.minimum(shared, cap)


def _range_min(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value between ``first`` and ``last``, both included."""
    if not len(first):
        return np.zeros(0, values.dtype)
    width = last - first + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    table = values
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        here = level == k
        out[here] = np.minimum(table[first[here]], table[last[here] - (1 << k) + 1])
    return out


class _Inducer:
    """One pass: ``take`` scans suffixes in order and queues their predecessors of one type."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, cap: int, memory: int):
        self.text, self.wanted, self.cap = text, wanted, cap
        self.queue = BucketQueue(memory)
        self.least = np.full(BUCKETS, cap, np.uint16)  # shared by all scanned since a bucket's last entry
        self.empty = np.ones(BUCKETS, bool)

    def take(self, place: np.ndarray, lcp: np.ndarray) -> None:
        before = np.minimum.accumulate(lcp)
        index = np.nonzero((place > 0) & self.wanted[place - 1])[0]
        if len(index):
            new = place[index] - 1
            char = self.text[new]
            order = np.argsort(char, kind="stable")
            index, new, char = index[order], new[order], char[order]
            first = np.concatenate([[True], char[1:] != char[:-1]])
            least = np.empty(len(index), np.uint16)
            least[first] = np.minimum(self.least[char[first]], before[index[first]])
            later = np.nonzero(~first)[0]
            least[later] = _range_min(lcp, index[later - 1] + 1, index[later])
            shared = np.minimum(least + np.uint16(1), np.uint16(self.cap)).astype(np.uint16)
            edges = np.append(np.nonzero(first)[0], len(char))
            self.least = np.minimum(self.least, before[-1])
            after = np.append(np.minimum.accumulate(lcp[::-1])[::-1], np.uint16(self.cap))
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                c = int(char[start])
                if self.empty[c]:
                    shared[start] = 0
                    self.empty[c] = False
                self.queue.push(c, new[start:end].astype(np.int32), shared[start:end])
                self.least[c] = after[index[end - 1] + 1]
        else:
            self.least = np.minimum(self.least, before[-1])


def suffix_array(text: np.ndarray, cap: int, memory: int = 64 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` in order of their first ``cap`` bytes, and the prefix length that each
    shares with the one before (at most ``cap``). The text ends with its only 0 of the last
    two bytes; other 0 bytes may separate parts."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32), np.zeros(1, np.uint16)
    is_s = rising(text)
    words = _words(text)
    starts = np.nonzero(is_s[1:] & ~is_s[:-1])[0] + 1
    star, star_lcp = sorted_starts(text, words, starts, cap)
    edges = np.searchsorted(text[star], np.arange(BUCKETS + 1))

    def seam(a: int, b: int) -> int:
        return int(extend(text, words, np.array([a]), np.array([b]), np.zeros(1, np.int64), cap)[0])

    falling = _Inducer(text, ~is_s, cap, memory)
    done = BucketQueue(memory)
    for c in range(BUCKETS):
        last = None
        for place, lcp in falling.queue.pop(c):
            done.push(c, place, lcp)
            falling.take(place, lcp)
            last = int(place[-1])
        own = slice(int(edges[c]), int(edges[c + 1]))
        if own.start < own.stop:
            lcp = star_lcp[own].copy()
            lcp[0] = 0 if last is None else seam(last, int(star[own.start]))
            falling.take(star[own], lcp)
    del star, star_lcp
    rise = _Inducer(text, is_s, cap, memory)
    places, shares = [], []  # falling order; a share is with the one scanned before
    for c in range(BUCKETS - 1, -1, -1):
        last = None
        for place, lcp in rise.queue.pop(c):
            rise.take(place, lcp)
            places.append(place)
            shares.append(lcp)
            last = int(place[-1])
        if c == 0:
            places.append(np.array([n - 1], np.int32))
            shares.append(np.array([0 if last is None else 1], np.uint16))
        parts = list(done.pop(c))
        if parts:
            place = np.concatenate([p for p, _ in parts])[::-1]
            lcp = np.concatenate([s for _, s in parts])
            lcp = np.concatenate([[0 if last is None else seam(int(place[0]), last)], lcp[:0:-1]]).astype(np.uint16)
            rise.take(place, lcp)
            places.append(place)
            shares.append(lcp)
    place, share = np.concatenate(places)[::-1], np.concatenate(shares)[::-1]
    return place, np.append(np.uint16(0), share[:-1])
