"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def components(nodes, links):
    """{node: smallest node reachable}."""
    parent = {n: n for n in nodes}
    for a, b in links:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {n: find(parent, n) for n in nodes}


def remove_repeats(docs, t):
    """[(doc_id, n_words, n_removed, kept)] for [(doc_id, text)]."""
    first = {}
    for d, text in docs:
        w = words(text)
        if d is not None:
            for i in range(len(w) - t + 1):
                key = tuple(w[i:i + t])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, text in docs:
        w, gone = words(text), set()
        for i in range(len(w) - t + 1):
            if d is not None and first[tuple(w[i:i + t])] < d:
                gone.update(range(i, i + t))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), " ".join(kept)))
    return out


def shingle_set(text, k):
    w = words(re.sub("[A-Z]", lambda m: m.group(0).lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def jaccard_components(docs, k, percent):
    """[(doc_id, size, component)] for [(doc_id, text)], ids not null."""
    sets = [(d, shingle_set(t, k)) for d, t in docs]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if x and y and 100 * len(x & y) >= percent * len(x | y)]
    group = components({d for d, _ in sets}, links)
    return [(d, len(s), group[d]) for d, s in sets]
