"""Suffix order and common prefixes by external induced sorting.

Only the suffixes that start a descent's foot (S*: smaller than the next, after one that is larger) are sorted outright; the order of
all others is induced from them, first of those larger than their successor (L), then of the rest (S). A suffix waits in a queue of
its first character until the scan comes there; queues hold tuples (place, common prefix with the one before it in the queue) and
write themselves to disk beyond a bound of memory. A tuple arrives with its key in rising order, so first in, first out is the order
of priority. Common prefixes go along: two suffixes with the same first character have one more character in common than their
successors, and between successors it is the least along the scan. Prefixes count up to ``depth`` only.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Tuples that the queues of one scan hold in memory before they are written to disk.
HELD = 4_000_000
BLOCK = 1 << 18


class Queues:
    """A first-in-first-out queue for each character, on disk beyond HELD tuples in all."""

    def __init__(self, held: int = 0) -> None:
        self.chunks: dict[int, list] = {}
        self.most, self.in_memory, self.file = held or HELD, 0, None

    def push(self, key: int, place: np.ndarray, common: np.ndarray) -> None:
        self.chunks.setdefault(key, []).append((place, common))
        self.in_memory += len(place)
        if self.in_memory > self.most:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()  # gone when closed, whatever happens to the task
        for chunks in self.chunks.values():
            for i, c in enumerate(chunks):
                if not isinstance(c[0], int):
                    at = self.file.seek(0, 2)
                    self.file.write(c[0].astype(np.int64).tobytes() + c[1].astype(np.int16).tobytes())
                    chunks[i] = (at, len(c[0]))
        self.in_memory = 0

    def pop(self, key: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All that the queue holds now, in blocks of about BLOCK tuples."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for c in self.chunks.pop(key, []):
            if isinstance(c[0], int):
                self.file.seek(c[0])
                c = np.frombuffer(self.file.read(8 * c[1]), np.int64), np.frombuffer(self.file.read(2 * c[1]), np.int16)
            else:
                self.in_memory -= len(c[0])
            held.append(c)
            n += len(c[0])
            if n >= BLOCK:
                yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                held, n = [], 0
        if held:
            yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a[i] and b[i], up to depth."""
    out = np.zeros(len(a), np.int16)
    left = np.arange(len(a))
    n = len(text)
    for k in range(depth):
        x, y = a[left] + k, b[left] + k
        left = left[(x < n) & (y < n)]
        left = left[text[a[left] + k] == text[b[left] + k]]
        if not len(left):
            break
        out[left] += 1
    return out


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """As common_prefix, for many pairs of unlike suffixes of a text of 16-bit integers: four at a time. The text's only 0 ends them."""
    t = np.concatenate([text, np.zeros(3, np.uint16)]).astype(np.uint64)
    four = t[:-3] | t[1:-2] << np.uint64(16) | t[2:-1] << np.uint64(32) | t[3:] << np.uint64(48)
    out = np.full(len(a), depth, np.int16)
    left = np.arange(len(a))
    for k in range(0, depth, 4):
        differ = four[a[left] + k] ^ four[b[left] + k]
        at = np.flatnonzero(differ)
        d = differ[at]
        same = ((d & np.uint64(0xFFFF)) == 0).astype(np.int16) + ((d & np.uint64(0xFFFFFFFF)) == 0) + ((d & np.uint64(0xFFFFFFFFFFFF)) == 0)
        out[left[at]] = np.minimum(k + same, depth)
        left = left[differ == 0]
        if not len(left):
            break
    return out


class Scan:
    """Places that were passed in suffix order, and what that says about the common prefixes of their predecessors."""

    def __init__(self, queues: Queues, characters: int, depth: int) -> None:
        self.queues, self.depth = queues, depth
        self.least = np.zeros(characters, np.int16)  # along the scan since the character's queue last grew

    def induce(self, place: np.ndarray, character: np.ndarray, at: np.ndarray, common: np.ndarray) -> None:
        """at[i] is where in the block, whose common prefixes with the one before are common, place[i] was met."""
        total = int(common.min())
        if not len(place):
            np.minimum(self.least, total, out=self.least)
            return
        order = np.argsort(character, kind="stable")
        ch, pl, j = character[order], place[order], at[order]
        new = np.concatenate([[True], ch[1:] != ch[:-1]])
        lo = np.where(new, 0, np.concatenate([[0], j[:-1] + 1]))
        padded = np.append(common, np.int16(self.depth))
        pairs = np.stack([lo, j + 1], 1).reshape(-1)
        low = np.minimum.reduceat(padded, pairs)[::2]
        starts = np.flatnonzero(new)
        low[starts] = np.minimum(low[starts], self.least[ch[starts]])
        value = np.minimum(low + 1, self.depth).astype(np.int16)
        ends = np.append(starts[1:], len(ch))
        np.minimum(self.least, total, out=self.least)
        tails = np.minimum.reduceat(padded, np.stack([j[ends - 1] + 1, np.full(len(ends), len(common))], 1).reshape(-1))[::2]
        self.least[ch[starts]] = tails
        for s, e in zip(starts, ends, strict=True):
            self.queues.push(int(ch[s]), pl[s:e], value[s:e])


def _kinds(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next (S); the last one is."""
    n = len(text)
    up = np.ones(n, bool)
    up[:-1] = text[:-1] < text[1:]
    differs = np.ones(n, bool)
    differs[:-1] = text[:-1] != text[1:]
    nearest = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    return up[nearest]


def _induced(text: np.ndarray, seeds: np.ndarray, seed_common: np.ndarray, depth: int, held: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks (places, common prefix with the place before) of all suffixes, from the largest to the smallest, but for the seeds' own order."""
    characters = int(text.max()) + 1
    queues = Queues(held)
    scan = Scan(queues, characters, depth)
    store = Queues(held)
    key = text[seeds]
    edges = np.searchsorted(key, np.arange(characters + 1))

    def step(place: np.ndarray, common: np.ndarray, c: int, larger: bool, strict: bool) -> None:
        before = place - 1
        ok = before >= 0
        ch = text[np.maximum(before, 0)]
        if larger:
            ok &= ch >= c if not strict else ch > c
        else:
            ok &= ch <= c if not strict else ch < c
        at = np.flatnonzero(ok)
        scan.induce(before[at], ch[at], at, common)

    for c in range(characters):
        last = None
        while c in queues.chunks:
            for place, common in queues.pop(c):
                if last is None:
                    common[0] = 0
                step(place, common, c, True, False)
                store.push(c, place, common)
                last = place[-1]
        lo, hi = edges[c], edges[c + 1]
        for s in range(lo, hi, BLOCK):
            place, common = seeds[s : min(s + BLOCK, hi)], seed_common[s : min(s + BLOCK, hi)].copy()
            if s == lo:
                common[0] = 0 if last is None else common_prefix(text, np.array([last]), place[:1], depth)[0]
            step(place, common, c, True, True)
    queues = Queues(held)
    scan = Scan(queues, characters, depth)
    for c in range(characters - 1, -1, -1):
        last = None
        while c in queues.chunks:
            for place, common in queues.pop(c):
                if last is None:
                    common[0] = 0
                step(place, common, c, False, False)
                last = place[-1]
                yield place, common
        after = None  # what the one behind (larger) has in common with the next of these
        for place, common in reversed(list(store.pop(c))):
            place, forward = place[::-1], common[::-1]
            down = np.empty(len(place), np.int16)
            down[1:] = forward[:-1]
            if after is not None:
                down[0] = after
            else:
                down[0] = 0 if last is None else common_prefix(text, np.array([last]), place[:1], depth)[0]
            after = forward[-1]
            step(place, down, c, False, True)
            yield place, down
    yield np.array([len(text) - 1]), np.zeros(1, np.int16)


def suffixes(text: np.ndarray, depth: int, held: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks (places, common prefix with the suffix before, up to depth) from the largest suffix of text to the smallest.

    text has integers from 1, and ends with a 0 that it has nowhere else. Suffixes are in order of their first ``depth`` characters
    at least; of those that agree so far, any order. An empty text gives its end only.
    """
    small = _kinds(text)
    start = small.copy()
    start[1:] &= ~small[:-1]
    start[0] = False
    feet = np.flatnonzero(start)
    if len(feet) > 1:
        # the feet, in order of the substrings up to the next foot: the same induction from feet in any order within a character
        order = feet[np.argsort(text[feet], kind="stable")]
        is_foot = np.zeros(len(text), bool)
        is_foot[feet] = True
        met = [p[is_foot[p]] for p, _ in _induced(text, order, np.zeros(len(order), np.int16), 1, held)]
        sorted_feet = np.concatenate(met)[::-1]
        # names: equal substrings get the same
        end = np.zeros(len(text), np.int64)
        end[feet] = np.append(feet[1:], len(text) - 1)
        a, b = sorted_feet[:-1], sorted_feet[1:]
        length = end[a] - a
        same = length == end[b] - b
        alive = np.flatnonzero(same)
        k = 0
        while len(alive):
            agree = text[a[alive] + k] == text[b[alive] + k]
            same[alive[~agree]] = False
            alive = alive[agree]
            alive = alive[length[alive] > k]
            k += 1
        name = np.empty(len(text), np.int64)
        name[sorted_feet] = np.concatenate([[0], np.cumsum(~same)])
        rank = name[feet]
        # the reduced string, recursively by ranks of twice as many names each time, until all differ or depth is reached
        width = 1
        while width <= depth and rank.max() + 1 < len(rank):
            nxt = np.full(len(rank), -1)
            nxt[:-width] = rank[width:] if width < len(rank) else nxt[:-width]
            both = rank * (len(rank) + 1) + nxt + 1
            _, rank = np.unique(both, return_inverse=True)
            width *= 2
        seeds = feet[np.argsort(rank, kind="stable")]
    else:
        seeds = feet
    seeds = np.append(len(text) - 1, seeds[seeds != len(text) - 1])
    shared = np.zeros(len(seeds), np.int16)
    shared[1:] = (common_prefixes if text.dtype == np.uint16 else common_prefix)(text, seeds[:-1], seeds[1:], depth)
    yield from _induced(text, seeds, shared, depth, held)
