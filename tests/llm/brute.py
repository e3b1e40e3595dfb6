"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def removed(docs, window=13):
    """Places of each row's words that a window also found under a smaller id covers."""
    least = {}
    for i, text in docs:
        if i is not None:
            w = words(text)
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, text in docs:
        w, gone = words(text), set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if least[tuple(w[k : k + window])] < i:
                    gone.update(range(k, k + window))
        out.append(gone)
    return out


def components(points, linked):
    parent = {p: p for p in points}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in points:
        for b in points:
            if a < b and linked(a, b):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {p: root(p) for p in points}


def grouped(pairs):
    out = defaultdict(list)
    for a, b in pairs:
        out[a].append(b)
    return out


def counts(items):
    return Counter(items)
