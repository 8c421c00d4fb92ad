"""Plain Python versions of the operators, for small inputs."""

import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = words(lowered(text))
    if not w:
        return []
    return [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]


def fingerprint(text, k=4):
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, k)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, linked):
    """Smallest node of each node's component; ``linked`` tests a pair."""
    label = {n: n for n in nodes}

    def find(n):
        while label[n] != n:
            n = label[n]
        return n

    ordered = sorted(nodes)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}
