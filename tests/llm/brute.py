"""Plain forms of what the operators compute, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None, low: bool = False) -> list[str]:
    return WORD.findall(lower(text) if low else text or "")


def shingles(text: str | None, size: int = 5) -> set[tuple[str, ...]]:
    w = words(text, low=True)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def repetition(text: str | None) -> tuple:
    text, w = text or "", words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, dup, len(inside), failed


def components(rows: list[tuple]) -> dict[int, tuple[int, int]]:
    """doc_id: (set size, smallest doc_id reachable by links)."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        for other, shared in Counter(e for x in sets[d] for e in holders[x]).items():
            if 100 * shared >= 75 * (len(sets[d]) + len(sets[other]) - shared):
                a, b = sorted((root(d), root(other)))
                parent[b] = a
        for x in sets[d]:
            holders[x].append(d)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def contained(docs: list[tuple], items: list[tuple]) -> set[tuple]:
    out = set()
    wanted = {(i, t): shingles(t) for i, t in items}
    for d, text in docs:
        own = {size: shingles(text, size) for size in range(1, 6)}
        for (i, _), s in wanted.items():
            if s:
                shared = len(s & own[min(5, len(next(iter(s))))])
                if 100 * shared >= 75 * len(s):
                    out.add((d, i, shared, len(s)))
    return out
