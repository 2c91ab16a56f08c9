"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_counts(text, n=5):
    words = WORD.findall(text or "")
    if not words:
        return Counter()
    if len(words) < n:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def jaccard(a, b):
    both = sum((a & b).values())
    total = sum((a | b).values())
    return both / total if total else 0.0


def classes(links, nodes):
    """Smallest node reachable from each node."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_copies(docs, least=0.8):
    """Class of each document of {id: text}."""
    counts = {d: shingle_counts(t) for d, t in docs.items()}
    by = defaultdict(list)
    for d, c in counts.items():
        for s in c:
            by[s].append(d)
    links = set()
    for members in by.values():
        links |= {(a, b) for a in members for b in members if a < b}
    good = [(a, b) for a, b in links if jaccard(counts[a], counts[b]) >= least]
    return classes(good, docs)


def line_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def repeated_spans(docs, size=50):
    """(n_bytes, n_removed, n_spans, kept bytes) of each document of {id: text}."""
    first = {}
    raw = {d: (t or "").encode() for d, t in docs.items()}
    for d in sorted(raw):
        b = raw[d]
        for i in range(len(b) - size + 1):
            first.setdefault(b[i : i + size], d)
    out = {}
    for d, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < d:
                gone[i : i + size] = b"\x01" * size
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)
    return out
