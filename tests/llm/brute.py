"""Plain Python versions of the operators, one document at a time, for comparison."""

import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality_counts(text):
    text = text or ""
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w),
    }


def js_distance(counts, shares):
    total = sum(counts)
    if not total:
        return None
    out = 0.0
    for c, q in zip(counts, shares, strict=True):
        p = c / total
        m = (p + q) / 2
        out += p * math.log2(p / m) if p else 0.0
        out += q * math.log2(q / m) if q else 0.0
    return math.sqrt(max(0.0, out / 2))


def shingles(text, n):
    w = [x.encode().lower() for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def components(rows, n, percent):
    """{(id, text): smallest id} over all pairs."""
    nodes = sorted(set(rows), key=lambda r: (r[0], r[1] or ""))
    sets = [shingles(t, n) for _, t in nodes]
    parent = list(range(len(nodes)))

    def find(i):
        while parent[i] != i:
            i = parent[i] = parent[parent[i]]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    parent[max(find(i), find(j))] = min(find(i), find(j))
    return {node: nodes[find(i)][0] for i, node in enumerate(nodes)}
