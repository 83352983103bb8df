"""Brute-force twins of the operators, over plain Python rows."""

from __future__ import annotations

import re
from collections import Counter

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, n: int) -> set:
    words = SPACE_WORDS.findall(lower_ascii(text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < n else {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def components(rows: list[tuple], n: int, percent: int) -> dict:
    """{id: (size of its set, smallest id reachable)} for rows (id, text) with distinct ids."""
    sets = {d: shingles(t, n) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [d for d in sets if sets[d] and d is not None]
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), None if d is None else find(d)) for d in sets}


def end_tokens(text: str | None) -> list:
    return SPACE_WORDS.findall(lower_ascii(text or "")) + [None]


def counts(texts) -> Counter:
    total: Counter = Counter()
    for t in texts:
        total.update(end_tokens(t))
    return total


def awkward(spark, rows: list[tuple]):
    """A documents table with columns whose names the operators use themselves, too."""
    full = [(d, t, "x", i % 3, "key", -1, 0.5, [1], "m") for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, key string, n int, node string, part int, "
                                       "score double, tokens array<int>, word string")
