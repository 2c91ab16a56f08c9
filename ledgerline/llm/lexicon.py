"""A minimal acyclic transducer that gives frequent words their ids.

Words that end alike share states. Each transition carries a number, and the numbers along a word's path add up to
the word's place in sorted order, under which its ids are stored. The automaton lies in one file of fixed-width
arrays that tasks map into memory; transitions are found by hashing (state, byte), many words at a time.
"""

from __future__ import annotations

import mmap

import numpy as np

from ledgerline.llm.bytepair import Merges

_MAGIC = 0x4C455831


class _State:
    __slots__ = ("next", "final", "number")

    def __init__(self):
        self.next, self.final, self.number = {}, False, -1


def minimal(words: list[bytes]) -> tuple[list[tuple[int, int, int]], list[bool], int]:
    """Transitions (state, byte, state), final states and the start, of sorted distinct words."""
    register: dict[tuple, _State] = {}
    states: list[_State] = []
    root, path, last = _State(), [], b""
    path.append(root)

    def close(down_to: int) -> None:
        while len(path) - 1 > down_to:
            child, byte = path.pop(), last[len(path) - 1]
            key = (child.final, *((b, s.number) for b, s in child.next.items()))
            same = register.get(key)
            if same is None:
                child.number = len(states)
                states.append(child)
                register[key] = same = child
            path[-1].next[byte] = same

    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        for byte in word[common:]:
            path.append(_State())
            path[-2].next[byte] = path[-1]
        path[-1].final = True
        last = word
    close(0)
    root.number = len(states)
    states.append(root)
    moves = [(s.number, b, t.number) for s in states for b, t in sorted(s.next.items())]
    return moves, [s.final for s in states], root.number


def compiled(words: list[bytes], merges: Merges) -> bytes:
    """The file: transducer of the distinct non-empty ``words``, and their ids."""
    words = sorted({w for w in words if w})
    moves, final, root = minimal(words)
    n = len(final)
    ways, out = np.array(final, dtype=np.int64), np.zeros(len(moves), dtype=np.int32)
    at = 0
    for s in range(n):  # states are numbered after those they lead to
        passed = int(final[s])
        while at < len(moves) and moves[at][0] == s:
            out[at] = passed
            passed += int(ways[moves[at][2]])
            at += 1
        ways[s] = passed
    bits = max(4, int(2 * len(moves) + 1).bit_length())
    key = np.full(1 << bits, -1, dtype=np.int64)
    value = np.zeros((2, 1 << bits), dtype=np.int32)
    for (s, b, t), o in zip(moves, out):
        k = s << 8 | b
        slot = _slot(np.array([k]), bits)[0]
        while key[slot] >= 0:
            slot = (slot + 1) & ((1 << bits) - 1)
        key[slot], value[0, slot], value[1, slot] = k, t, o
    ids = [merges.one(w) for w in words]
    size = np.array([len(x) for x in ids], dtype=np.int64)
    flat = np.array([i for x in ids for i in x], dtype=np.int32)
    head = np.array([_MAGIC, n, root, bits, len(words), len(flat)], dtype=np.int64)
    ends = np.cumsum(size)
    return b"".join(
        a.tobytes() for a in (head, key, ends, value, flat, np.array(final, dtype=np.uint8))
    )


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Lexicon:
    """A compiled file, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(held, dtype=np.int64, count=6)
        magic, self.states, self.root, self.bits, words, ids = (int(x) for x in head)
        if magic != _MAGIC:
            raise ValueError(f"{path} is no lexicon")
        at = 48

        def take(kind, count):
            nonlocal at
            got = np.frombuffer(held, dtype=kind, count=count, offset=at)
            at += got.nbytes
            return got

        self.key = take(np.int64, 1 << self.bits)
        self.ends = take(np.int64, words)
        self.to, self.out = take(np.int32, 1 << self.bits), take(np.int32, 1 << self.bits)
        self.ids = take(np.int32, ids)
        self.final = take(np.uint8, self.states)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word ``data[start:end]`` is known, and where in ``ids`` its ids lie and how many there are."""
        n = len(starts)
        state, place = np.full(n, self.root, dtype=np.int64), np.zeros(n, dtype=np.int64)
        alive, at = np.flatnonzero(ends > starts), starts.copy()
        known = np.zeros(n, dtype=bool)
        while len(alive):
            keys = state[alive] << 8 | data[at[alive]]
            slot = _slot(keys, self.bits)
            found, open_ = np.full(len(alive), -1, dtype=np.int64), np.arange(len(alive))
            while len(open_):
                held = self.key[slot[open_]]
                hit = held == keys[open_]
                found[open_[hit]] = slot[open_[hit]]
                open_ = open_[~hit & (held >= 0)]
                slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            on = found >= 0
            alive, found = alive[on], found[on]
            state[alive] = self.to[found]
            place[alive] += self.out[found]
            at[alive] += 1
            over = at[alive] == ends[alive]
            known[alive[over]] = self.final[state[alive[over]]] == 1
            alive = alive[~over]
        start, size = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        which = place[known]
        start[known] = np.where(which > 0, self.ends[which - 1], 0) if len(self.ends) else 0
        size[known] = self.ends[which] - start[known] if len(self.ends) else 0
        return known, start, size
