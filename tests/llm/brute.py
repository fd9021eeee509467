"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def smallest(n, links):
    roots = list(range(n))

    def find(i):
        while roots[i] != i:
            roots[i] = roots[roots[i]]
            i = roots[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        roots[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text, n):
    w = WORD.findall((text or "").encode().lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard(rows, n, percent):
    """{id: (size, component)} of (id, text) rows with distinct ids."""
    rows = sorted(rows)
    sets = [shingles(t, n) for _, t in rows]
    links = []
    for i, s in enumerate(sets):
        for j in range(i):
            t = sets[j]
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                links.append((j, i))
    found = smallest(len(rows), links)
    return {r[0]: (len(s), rows[f][0]) for r, s, f in zip(rows, sets, found, strict=True)}


def cosine(rows, threshold):
    """{id: (links, component)} of (id, vector) rows with distinct ids."""
    rows = sorted(rows, key=lambda r: r[0])
    unit = []
    for _, v in rows:
        ok = bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links = [
        (j, i)
        for i, x in enumerate(unit)
        for j, y in enumerate(unit[:i])
        if x is not None and y is not None and len(x) == len(y) and x @ y >= threshold
    ]
    n = Counter(i for link in links for i in link)
    found = smallest(len(rows), links)
    return {r[0]: (n[i], rows[found[i]][0]) for i, r in enumerate(rows)}


def repeats(rows, length):
    """{id: (bytes, removed, spans, sha256 of the rest)} of (id, text) rows with distinct ids."""
    seen, out = {}, {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            if seen.setdefault(data[p : p + length], i) < i:
                gone[p : p + length] = [True] * length
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        rest = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def code_bits(text, grams, order):
    """Bits of a text by the recursion of the definition; ``grams`` counts byte strings of order + 1."""
    counts = {}
    for g, n in grams.items():
        for k in range(order + 1):
            own = counts.setdefault(g[order - k : order], Counter())
            own[g[order]] += n

    def p(context, byte):
        if context is None:
            return 1 / 256
        below = p(context[1:] if context else None, byte)
        own = counts.get(context)
        if not own:
            return below
        total, distinct = sum(own.values()), len(own)
        return own[byte] / (total + distinct) + distinct / (total + distinct) * below

    data = b"\n" * order + text.encode()
    return -sum(np.log2(p(data[i - order : i], data[i])) for i in range(order, len(data)))
