"""Plain Python versions of the operators."""

import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(sets, percent):
    """Smallest id reachable over links of at least `percent`; `sets`: id -> set."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sets if sets[i]]
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                continue
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in sets}


def contamination(text, items):
    """(n_words, n_hit, item ids) of a text; `items`: [(id, text)]."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w = re.findall(pattern, (text or "").translate(LOWER))
    hit, found = set(), set()
    for name, item in items:
        v = re.findall(pattern, (item or "").translate(LOWER))
        n = min(13, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add("null" if name is None else str(name))
    return len(w), len(hit), sorted(found)


def base_quality(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for j in range(3)}
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, lines, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)
