"""Plain versions of the operators' results on small inputs."""

from __future__ import annotations

import collections
import itertools
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k=5):
    w = words(ascii_lower(text))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(rows, k=5, num=80, den=100):
    """{doc_id: (set size, least linked doc_id)} of (doc_id, text) with distinct ids."""
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def without_repeats(rows, window=20):
    """{doc_id: (words, removed, kept text)} of (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = words(t)
        keep = [True] * len(w)
        for p in range(len(w) - window + 1):
            g = tuple(w[p : p + window])
            if g in seen:
                keep[p : p + window] = [False] * window
            seen.add(g)
        out[i] = (len(w), keep.count(False), " ".join(itertools.compress(w, keep)))
    return out


def base_counts(text):
    """(words, word characters, symbols, repeated lines, words in repeated 5-word windows)."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def generalised_jaccard(a, b):
    a, b = collections.Counter(words(a)), collections.Counter(words(b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))
