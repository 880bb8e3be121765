"""Plain Python versions, one text at a time."""

import re
from collections import Counter

import xxhash

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text, k=3):
    own = words((text or "").translate(LOWER))
    if not own:
        return 0
    shingles = [" ".join(own[i : i + k]) for i in range(len(own) - k + 1)] or [" ".join(own)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, links):
    """Root index of every index; links: pairs of indices."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(ids))]


def removed(docs, k=13):
    """doc_id to the set of words that go; docs: (doc_id, text)."""
    own = [(i, words(t)) for i, t in docs]
    least = {}
    for i, w in own:
        if i is not None:
            for p in range(len(w) - k + 1):
                key = tuple(w[p : p + k])
                least[key] = min(least.get(key, i), i)
    gone = []
    for i, w in own:
        cut = set()
        for p in range(len(w) - k + 1 if i is not None else 0):
            if least[tuple(w[p : p + k])] < i:
                cut.update(range(p, p + k))
        gone.append((i, w, cut))
    return gone


def counts(text):
    text = text or ""
    own = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    often = Counter(windows)
    covered = {p for i, w in enumerate(windows) if often[w] > 1 for p in range(i, i + 5)}
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
