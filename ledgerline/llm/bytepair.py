"""Byte-level BPE over whole batches of texts: splitting into words, exact merges, and the way back to bytes.

The work is done on arrays: a text's words are found by character class, looked up by a 64-bit hash of their bytes
in a table of words met before, and only words that are new to a task are merged. The table is a cache of fixed
size, so memory does not grow with the corpus.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np

from ledgerline.llm.scan import prefix, stretch

LETTER, NUMBER, SPACE, OTHER = range(4)
#: White space as the pattern's \s has it.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
NONE = np.int32(2**31 - 1)
#: Words longer than this are merged one at a time.
LONG_WORD = 48
#: Texts are encoded so many bytes at a time.
SLICE = 1 << 19


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.uint8)
    out[WHITE] = SPACE
    return out


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes ``start, start + 1, ...`` of each stretch, one stretch after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def word_starts(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Which code points begin a word; ``heads`` marks those that begin a text.

    A word is a contraction ('s, 't, 're, 've, 'm, 'll, 'd), or a run of letters, of numbers or of other marks with
    one blank before it if there is one, or white space; the last white-space character before a mark stands alone.
    """
    n = len(points)
    kind = classes()[points]
    new = heads.copy()
    new[1:] |= kind[1:] != kind[:-1]
    start = new.copy()
    after = np.flatnonzero(new[1:] & ~heads[1:] & (kind[:-1] == SPACE)) + 1
    start[after[points[after - 1] == 32]] = False
    start[after - 1] = True
    quotes = np.flatnonzero((points == 39) & new & start)
    quotes = quotes[quotes + 1 < n]
    quotes = quotes[(kind[quotes + 1] == LETTER) & ~heads[quotes + 1]]
    if len(quotes):
        one, two = points[quotes + 1], points[np.minimum(quotes + 2, n - 1)]
        more = (quotes + 2 < n) & ~heads[np.minimum(quotes + 2, n - 1)]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = more & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        for which, size in ((single, 1), (double, 2)):
            at = quotes[which]
            start[at + 1] = False
            rest = at + 1 + size
            start[rest[rest < n]] = True
    return start


class Merges:
    """The vocabulary and merge table of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in printable} | {
            b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(printable)))
        }
        byte_of = {c: b for b, c in shown.items()}
        vocab = held["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.size = max(max(vocab.values()), *self.special.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, i in vocab.items():
            if token not in self.special:
                self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.of_byte = np.array([vocab[shown[b]] for b in range(256)], dtype=np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in held["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): (i, vocab[a + b]) for i, (a, b) in enumerate(pairs)}
        self._bits = 19
        self._key = np.full(1 << self._bits, -1, dtype=np.int64)
        self._value = np.zeros((2, 1 << self._bits), dtype=np.int32)
        for (a, b), (rank, new) in self.ranks.items():
            key = a << 20 | b
            at = self._slot(np.array([key]))[0]
            while self._key[at] >= 0:
                at = (at + 1) & ((1 << self._bits) - 1)
            self._key[at] = key
            self._value[:, at] = rank, new

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and new id of each pair; rank ``NONE`` if it is not merged."""
        keys = a.astype(np.int64) << 20 | b
        at = self._slot(keys)
        rank, new = np.full(len(keys), NONE), np.zeros(len(keys), dtype=np.int32)
        left = np.arange(len(keys))
        while len(left):
            held = self._key[at[left]]
            hit = held == keys[left]
            got = left[hit]
            rank[got], new[got] = self._value[0, at[got]], self._value[1, at[got]]
            left = left[~hit & (held >= 0)]
            at[left] = (at[left] + 1) & ((1 << self._bits) - 1)
        return rank, new

    def one(self, word: bytes) -> list[int]:
        """Ids of a single word, by a queue of its pairs: the way for long words."""
        ids = self.of_byte[np.frombuffer(word, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (got := self.ranks.get((ids[i], ids[j]))):
                heapq.heappush(queue, (got[0], i, ids[i], ids[j], got[1]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def many(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words ``data[start:end]``, one after the other, and how many each has."""
        sizes = ends - starts
        out: list[np.ndarray | None] = [None] * len(sizes)
        counts = np.zeros(len(sizes), dtype=np.int64)
        parts, order = [], []
        for low, high in ((0, 8), (8, 16), (16, LONG_WORD)):
            which = np.flatnonzero((sizes > low) & (sizes <= high))
            for at in range(0, len(which), 1 << 15):
                rows = which[at : at + (1 << 15)]
                ids, counts[rows] = self._matrix(data, starts[rows], sizes[rows])
                parts.append(ids)
                order.append(rows)
        for i in np.flatnonzero(sizes > LONG_WORD):
            out[i] = np.array(self.one(data[starts[i] : ends[i]].tobytes()), dtype=np.int32)
            counts[i] = len(out[i])
            parts.append(out[i])
            order.append(np.array([i]))
        if not parts:
            return np.zeros(0, dtype=np.int32), counts
        flat, order = np.concatenate(parts), np.concatenate(order)
        at = np.zeros(len(sizes), dtype=np.int64)
        at[order] = np.cumsum(counts[order]) - counts[order]
        return flat[ragged(at, counts)], counts

    def _matrix(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, width = len(sizes), int(sizes.max())
        column = np.arange(width)
        inside = column < sizes[:, None]
        ids = np.full((rows, width + 1), -1, dtype=np.int32)
        ids[:, :-1][inside] = self.of_byte[data[ragged(starts, sizes)]]
        after = np.tile(np.arange(1, width + 2, dtype=np.int32), (rows, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int32), (rows, 1))
        rank, new = np.full((rows, width), NONE), np.zeros((rows, width), dtype=np.int32)
        pair = column[:-1] < sizes[:, None] - 1
        r, c = np.nonzero(pair)
        rank[r, c], new[r, c] = self.find(ids[r, c], ids[r, c + 1])
        active = np.arange(rows)
        while len(active):
            p = np.argmin(rank[active], axis=1)
            go = rank[active, p] < NONE
            active, p = active[go], p[go]
            if not len(active):
                break
            q = after[active, p]
            nxt = after[active, q]
            ids[active, p] = new[active, p]
            ids[active, q] = -1
            after[active, p] = nxt
            rank[active, q] = NONE if width else NONE
            has = nxt < sizes[active]
            a, i, j = active[has], p[has], nxt[has]
            before[a, j] = i
            rank[active, p] = NONE
            rank[a, i], new[a, i] = self.find(ids[a, i], ids[a, j])
            b = before[active, p]
            has = b >= 0
            a, i, j = active[has], b[has], p[has]
            rank[a, i], new[a, i] = self.find(ids[a, i], ids[a, j])
        keep = ids[:, :-1] >= 0
        return ids[:, :-1][keep], keep.sum(axis=1)


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


class Words:
    """The words of a batch of texts: ``data`` (UTF-8), ``starts``, ``ends``, ``hashes`` and ``count`` per text."""

    def __init__(self, texts: list[str], special: dict[str, int]):
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le", "replace"), dtype=np.uint32)
        heads = np.zeros(len(points) + 1, dtype=bool)
        at = np.cumsum([0, *map(len, texts)])
        heads[at] = True
        held = []
        for token in special:
            for i, text in enumerate(texts):
                j = text.find(token)
                while j >= 0:
                    held.append((at[i] + j, at[i] + j + len(token)))
                    j = text.find(token, j + len(token))
        for a, b in held:
            heads[a] = heads[b] = True
        heads = heads[:-1]
        start = word_starts(points, heads) if len(points) else heads
        for a, b in held:
            start[a + 1 : b] = False
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        offset = np.zeros(len(points) + 1, dtype=np.int64)
        np.cumsum(width, out=offset[1:])
        first = np.flatnonzero(start)
        self.data = np.frombuffer(whole.encode("utf-8", "replace"), dtype=np.uint8)
        self.starts = offset[first]
        self.ends = np.append(self.starts[1:], offset[-1:] if len(first) else self.starts[:0])
        self.hashes = stretch(prefix(self.data), self.starts, self.ends)
        self.count = np.diff(np.searchsorted(first, at))


class Encoder:
    """Encodes batches of texts; keeps the ids of words met before in a table of fixed size.

    ``lexicon``, if given, knows the ids of frequent words (``find``); other words are merged. Two different words
    with the same 64-bit hash would be taken for one: among a million words the odds are one in thirty million.
    """

    BITS = 19

    def __init__(self, path: str, lexicon=None):
        self.merges = merges(path)
        self.lexicon = lexicon
        self._clear()
        token = self.merges.bytes_of
        self.token_bytes = np.frombuffer(b"".join(token), dtype=np.uint8)
        self.token_size = np.array([len(t) for t in token], dtype=np.int64)
        self.token_at = np.cumsum(self.token_size) - self.token_size

    def _clear(self) -> None:
        self._key = np.zeros(1 << self.BITS, dtype=np.uint64)
        self._at = np.zeros(1 << self.BITS, dtype=np.int64)
        self._size = np.zeros(1 << self.BITS, dtype=np.int64)
        self._flat = np.zeros(1 << 22, dtype=np.int32)
        self._used = 0

    def _resolve(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words."""
        special = {t.encode(): i for t, i in self.merges.special.items()}
        known = np.zeros(len(starts), dtype=bool)
        counts = np.zeros(len(starts), dtype=np.int64)
        at = np.zeros(len(starts), dtype=np.int64)
        pools, base = [], 0
        if self.lexicon is not None:
            known, found, size = self.lexicon.find(data, starts, ends)
            at[known], counts[known] = found[known], size[known]
            pools.append(self.lexicon.ids)
            base = len(self.lexicon.ids)
        lengths = {len(t) for t in special}
        for i in np.flatnonzero(np.isin(ends - starts, list(lengths)) & ~known):
            token = special.get(data[starts[i] : ends[i]].tobytes())
            if token is not None:
                known[i], at[i], counts[i] = True, base, 1
                pools.append(np.array([token], dtype=np.int32))
                base += 1
        rest = np.flatnonzero(~known)
        ids, size = self.merges.many(data, starts[rest], ends[rest])
        at[rest], counts[rest] = base + np.cumsum(size) - size, size
        pool = np.concatenate([*pools, ids]) if pools else ids
        return pool[ragged(at, counts)], counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        words = Words(texts, self.merges.special)
        slot = (words.hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        at, size = self._at[slot], self._size[slot]
        missed = np.flatnonzero((self._key[slot] != words.hashes) | (size == 0))
        if len(missed):
            new, first, which = np.unique(words.hashes[missed], return_index=True, return_inverse=True)
            first = missed[first]
            ids, counts = self._resolve(words.data, words.starts[first], words.ends[first])
            if self._used + len(ids) > len(self._flat):
                hit = np.ones(len(slot), dtype=bool)
                hit[missed] = False
                old, back = np.unique(slot[hit], return_inverse=True)
                kept, old_at, old_size = self._flat[ragged(self._at[old], self._size[old])], self._at[old], self._size[old]
                moved = np.cumsum(old_size) - old_size
                self._clear()
                if len(kept) + len(ids) > len(self._flat):
                    self._flat = np.zeros(len(kept) + len(ids), dtype=np.int32)
                self._flat[: len(kept)] = kept
                self._used = len(kept)
                at[hit] = moved[back]
            here = self._used + np.cumsum(counts) - counts
            self._flat[self._used : self._used + len(ids)] = ids
            self._used += len(ids)
            to = (new >> np.uint64(64 - self.BITS)).astype(np.int64)
            self._key[to], self._at[to], self._size[to] = new, here, counts
            at[missed], size[missed] = here[which], counts[which]
        ids = self._flat[ragged(at, size)]
        per_word = np.concatenate([[0], np.cumsum(size)])
        ends = np.cumsum(words.count)
        return ids, per_word[ends] - per_word[ends - words.count]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        return self.token_bytes[ragged(self.token_at[ids], self.token_size[ids])].tobytes()


def slices(texts: list[str]) -> list[slice]:
    """Consecutive slices of about ``SLICE`` characters; a longer text stands alone."""
    from ledgerline.llm.common import by_bytes

    return by_bytes(np.array([len(t) for t in texts], dtype=np.int64), SLICE)


def whole(texts) -> list[str]:
    """Null texts as empty ones."""
    return [t if isinstance(t, str) else "" for t in texts]
