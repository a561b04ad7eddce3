"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(fold(text))


def repeats(texts, length=400):
    """(n_bytes, n_removed, n_spans, kept sha) per text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, sha(bytes(b for b, g in zip(d, gone) if not g))))
    return out


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def links(rows):
    """doc_id -> (class_id, n_links) by comparing all pairs that share a shingle."""
    sets = [(i, shingles(t)) for i, t in rows]
    holders = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    degree = []
    for k, (_, s) in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j != k)
        near = [j for j, n in shared.items() if 5 * n >= 4 * (len(s) + len(sets[j][1]) - n)]
        degree.append(len(near))
        for j in near:
            a, b = sorted((root(k), root(j)))
            parent[b] = a
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), i), i)
    return {i: (least[root(k)], degree[k]) for k, (i, _) in enumerate(sets)}


def contamination(text, items, window=10):
    """(hit word positions, item names)."""
    w, hit, found = words(text), set(), set()
    for name, body in items:
        b = words(body)
        m = min(window, len(b))
        grams = {tuple(b[i:i + m]) for i in range(len(b) - m + 1)} if b else set()
        for i in range(len(w) - m + 1) if m else ():
            if tuple(w[i:i + m]) in grams:
                hit |= set(range(i, i + m))
                found.add(name)
    return hit, found
