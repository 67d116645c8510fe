"""Plain versions of operators, quadratic where that is simplest."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def bag(text, n=5):
    ws = words(text)
    if not ws:
        return Counter()
    return Counter(tuple(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1)))


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def classes(rows, threshold=0.8):
    """``{position: class id}`` for ``[(id, text)]``, over all pairs that share a shingle."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = defaultdict(list)
    for i, b in enumerate(bags):
        for s in b:
            index[s].append(i)
    seen = set()
    for same in index.values():
        for k, i in enumerate(same):
            for j in same[k + 1:]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    if jaccard(bags[i], bags[j]) >= threshold:
                        parent[root(j)] = root(i)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[root(i)].append(doc)
    return {
        i: doc if not bags[i] else min((d for d in ids[root(i)] if d is not None), default=None)
        for i, (doc, _) in enumerate(rows)
    }


def remove_repeats(rows, window=20):
    """``{id: (n_words, n_removed, kept)}`` for rows of distinct ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        ws = words(text)
        gone = set()
        for i in range(len(ws) - window + 1):
            seq = tuple(ws[i:i + window])
            if seq in seen:
                gone.update(range(i, i + window))
            seen.add(seq)
        out[doc] = (len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone))
    return out
