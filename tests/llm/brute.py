"""Plain single-machine versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def lines(rows: list[tuple[int | None, str | None]], min_docs: int = 5, min_chars: int = 40) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, kept) of each row."""
    key = lambda line: line.strip(BLANK).translate(UP)
    n, last = defaultdict(int), {}
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            n[k] += 1
            d_ = float("-inf") if d is None else d
            last[k] = max(last.get(k, float("-inf")), d_)
    out = []
    for d, t in rows:
        own = (t or "").split("\n")
        stay = [x for x in own if len(key(x)) < min_chars or n[key(x)] < min_docs or last[key(x)] == (float("-inf") if d is None else d)]
        out.append((d, len(own), len(own) - len(stay), "\n".join(stay)))
    return out


def shingles(text: str | None, k: int = 5) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def components(nodes, links) -> dict:
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def near(rows: list[tuple[int | None, str | None]], percent: int = 85) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept) of each row; null ids alone,
    rows without words under their own id."""
    sets = [shingles(t) for _, t in rows]
    low: dict[frozenset, int] = {}
    for (d, _), s in zip(rows, sets):
        if d is not None and s:
            low[s] = min(d, low.get(s, d))
    texts = sorted(low, key=low.__getitem__)
    by = defaultdict(list)
    for i, s in enumerate(texts):
        for x in s:
            by[x].append(i)
    links = []
    for i, s in enumerate(texts):
        n = defaultdict(int)
        for x in s:
            for j in by[x]:
                if j > i:
                    n[j] += 1
        links += [(i, j) for j, c in n.items() if 100 * c >= percent * (len(s) + len(texts[j]) - c)]
    comp = components(range(len(texts)), links)
    least = {texts[i]: low[texts[c]] for i, c in comp.items()}
    out = []
    for (d, _), s in zip(rows, sets):
        c = d if d is None or not s else least[s]
        out.append((d, len(s), c, d is None or c == d))
    return out
