"""Small brute-force helpers of the operator tests."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def union_find(nodes, pairs):
    """Smallest member of each node's component."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def documents(spark, rows):
    """A documents table of (doc_id, text[, lang[, source]]) rows."""
    full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)
