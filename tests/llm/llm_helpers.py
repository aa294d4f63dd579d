"""Brute force and made-up texts that several tests share."""

from collections import Counter

import numpy as np

from tallyboard.llm import near_dedup as n


def brute(rows):
    """Classes by comparing all pairs, with weights by the definition."""
    runs = []
    for _, text in rows:
        w = (text or "").encode().split()
        runs.append(Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)) if w))
    uses = Counter(r for c in runs for r in c)
    total = len(rows)
    idf = {r: min(1.0, np.log(total / u) / np.log(1 / n.COMMON)) if u >= total * n.COMMON else 1.0 for r, u in uses.items()}
    weight = {r: n.IDF_FLOOR + (1 - n.IDF_FLOOR) * x for r, x in idf.items()}
    parent = list(range(total))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(total):
        for b in range(a):
            keys = runs[a].keys() | runs[b].keys()
            both = sum(min(runs[a][r], runs[b][r]) * weight[r] for r in keys)
            either = sum(max(runs[a][r], runs[b][r]) * weight[r] for r in keys)
            same = (rows[a][1] or "").split() == (rows[b][1] or "").split()
            if same or either and both / either >= n.SIMILARITY:
                parent[find(a)] = find(b)
    first: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        first[find(i)] = min(first.get(find(i), (True, 0)), (doc_id is None, doc_id or 0))
    return sorted(((doc_id, first[find(i)][1] if not first[find(i)][0] else None) for i, (doc_id, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["class_id"]) for r in df.collect()), key=str)


def changed(rng, words, n_changes):
    words = list(words)
    for i in rng.sample(range(len(words)), n_changes):
        words[i] = f"new{rng.random()}"
    return " ".join(words)
