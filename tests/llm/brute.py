"""Contracts and methods done the plain way, to hold the operators against."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_tiles(a, b, least=3):
    """Greedy string tiling by trying all pairs of places again for every tile."""
    used_a, used_b, out = [x == 0 for x in a], [x == 0 for x in b], []
    where = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    while True:
        best, at = 0, None
        for i in range(len(a)):
            for j in where.get(a[i], ()):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not used_a[i + k] and not used_b[j + k]:
                    k += 1
                if k > best:
                    best, at = k, (i, j)
        if best < least:
            return out
        out.append((*at, best))
        for k in range(best):
            used_a[at[0] + k] = used_b[at[1] + k] = True


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    cover = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(cover), len(words) < 10 or 100 * len(cover) > 20 * len(words)
