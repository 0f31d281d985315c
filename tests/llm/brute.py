"""Plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


class Groups:
    def __init__(self, nodes):
        self.parent = {node: node for node in nodes}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[n : n + size]) for n in range(max(1, len(words) - size + 1))} if words else set()


def jaccard_components(rows):
    sets = [(doc, shingles(text)) for doc, text in rows if doc is not None]
    groups = Groups(doc for doc, _ in sets)
    holders = defaultdict(list)
    for n, (_, own) in enumerate(sets):
        for shingle in own:
            holders[shingle].append(n)
    for n, (doc, own) in enumerate(sets):
        for other, both in Counter(m for shingle in own for m in holders[shingle] if m < n).items():
            if 100 * both >= 75 * (len(own) + len(sets[other][1]) - both):
                groups.join(doc, sets[other][0])
    return sorted((doc, len(own), groups.find(doc)) for doc, own in sets)


def remove_repeats(rows, length):
    data = [(key, (text or "").encode()) for key, text in rows]
    seen = Counter(text[n : n + length] for _, text in data for n in range(len(text) - length + 1))
    result = []
    for key, text in data:
        gone = [False] * len(text)
        for n in range(len(text) - length + 1):
            if seen[text[n : n + length]] > 1:
                gone[n : n + length] = [True] * length
        spans = sum(1 for n, g in enumerate(gone) if g and not (n and gone[n - 1]))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        result.append((str(key), len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result)


def base_digest(text, kinds):
    """``kinds``: name, pattern, test of a match."""
    spans = sorted(
        (m.start(), n, m.end()) for n, (_, pattern, holds) in enumerate(kinds) for m in pattern.finditer(text or "") if holds(m)
    )
    listed = ",".join(f"{kinds[n][0]}:{start}:{end}" for start, n, end in spans)
    return hashlib.sha256(listed.encode()).hexdigest(), Counter(kinds[n][0] for _, n, _ in spans)
