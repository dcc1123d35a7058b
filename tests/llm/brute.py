"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
from collections import Counter

import xxhash


def repeated_bytes(texts: list[bytes], window: int) -> list[tuple[int, int, int, str]]:
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, b"\0" + bytes(gone), strict=False))
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_words(texts: list[bytes], window: int) -> list[tuple[int, int, str]]:
    words = [t.split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def simhash(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    words = text.lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, seed) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(ids: list, marks: list[int], distance: int) -> dict:
    parent = {m: m for m in marks}

    def root(m):
        while parent[m] != m:
            m = parent[m]
        return m

    distinct = sorted(set(marks))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                parent[root(b)] = root(a)
    smallest = {}
    for i, m in zip(ids, marks, strict=True):
        smallest[root(m)] = min(i, smallest.get(root(m), i))
    return {i: smallest[root(m)] for i, m in zip(ids, marks, strict=True)}


def near_groups(rows: list[tuple[int, str]], least: float = 0.8) -> dict[int, int]:
    """Of each id the smallest id reachable over pairs whose five-word shingle sets reach the similarity."""
    sets, holders = {}, {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else {i}
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, own in sets.items():
        met = Counter(j for s in own for j in holders[s] if j > i)
        for j, both in met.items():
            if both / (len(own) + len(sets[j]) - both) >= least:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return {i: root(i) for i in group}
