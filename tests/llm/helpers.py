"""Brute force, written apart from the operators."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def shingle_set(text, k=5):
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def contamination(text, items, window=10):
    """(words, words hit, item names)."""
    w = words(text)
    hit, names = set(), set()
    for name, item in items:
        v = words(item)
        n = min(window, len(v))
        windows = {tuple(v[j : j + n]) for j in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                names.add(str(name))
    return len(w), len(hit), sorted(names)


def kept_bytes(texts, length=400):
    """What is left of each text after repeated strings of ``length`` bytes went."""
    texts = [(t or "").encode() for t in texts]
    count = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        out.append(bytes(b for b, g in zip(t, gone, strict=True) if not g))
    return out


def jaccard_classes(texts, threshold=Fraction(4, 5)):
    """Component and degree of each text, by its place."""
    sets = [shingle_set(t) for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    parent, degree = list(range(len(texts))), [0] * len(texts)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, c in Counter(j for g in s for j in holders[g] if j > i).items():
            if Fraction(c, len(s | sets[j])) >= threshold:
                degree[i] += 1
                degree[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], degree


def mixed(rows, weights=(5, 2, 1)):
    """Targets by source: shares by weight, capped at three times the source, excess reshared."""
    sizes = Counter()
    for source, text in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_sources, left = {}, set(order), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_sources}, sizes
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_sources -= over
