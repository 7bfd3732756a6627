"""Brute-force versions of the operators, on plain lists."""

from __future__ import annotations

import hashlib
from collections import Counter

import duckdb


def table(sf_dir, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


def words(text):
    return (text or "").encode().split()


def shingles(text, size=5):
    w = words((text or "").encode().lower().decode())
    return {tuple(w[i: i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def components(docs, percent=85):
    """docs: list of (id, text). The smallest id each can reach, by position."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_shingle = {}
    for i, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in by_shingle[x] if j > i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), d), d)
    return [least[root(i)] for i in range(len(docs))]


def without_repeats(texts, window=35):
    """The kept words of every text."""
    seen = Counter()
    split = [words(t) for t in texts]
    for w in split:
        seen.update(tuple(w[i: i + window]) for i in range(len(w) - window + 1))
    kept = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i: i + window])] > 1:
                gone[i: i + window] = [True] * window
        kept.append([x for x, g in zip(w, gone, strict=True) if not g])
    return split, kept


def sha256(kept):
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def leaks(docs, items, overlap=0.8):
    """(doc, item) pairs where the item's five-word shingles stand in the text."""
    from tablecheck.llm.shingles import plain_words

    def runs(w):
        return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    held = {i: runs(plain_words((t or "").encode())) for i, t in items}
    found = set()
    for d, t in docs:
        own = runs(plain_words((t or "").encode()))
        found |= {(d, i) for i, s in held.items() if s and len(s & own) >= overlap * len(s)}
    return found
