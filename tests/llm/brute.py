"""Plain Python versions of what the operators return."""

import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    raw = (text or "").encode()
    return WORD.findall(raw.translate(LOWER) if lower else raw)


def removed(texts, window=50):
    """[(id, text)] -> per row the list of covered flags; null ids are left alone."""
    first = {}
    split = [words(t) for _, t in texts]
    for (i, _), w in zip(texts, split):
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k: k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for (i, _), w in zip(texts, split):
        flags = [False] * len(w)
        for k in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[k: k + window])] < i:
                flags[k: k + window] = [True] * window
        out.append(flags)
    return out


def shingles(text, n=5):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k: k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(sets, percent=80):
    """Component number of each set (its smallest index)."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for k, s in enumerate(sets):
        common = Counter(j for g in s for j in where.get(g, ()))
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = find(k), find(j)
                parent[max(a, b)] = min(a, b)
        for g in s:
            where.setdefault(g, []).append(k)
    return [find(k) for k in range(len(sets))]
