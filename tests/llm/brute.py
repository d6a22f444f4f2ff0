"""Plain versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, width=5):
    words = WORDS.findall(lower(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def groups(rows):
    """Component of each id; rows of (id, text)."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def cut(rows, width=50):
    """For every row of (id, text): what is left, bytes removed, stretches removed."""
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        if i is not None:
            for p in range(len(data) - width + 1):
                key = data[p:p + width]
                first[key] = min(i, first.get(key, i))
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        if i is not None:
            for p in range(len(data) - width + 1):
                if first[data[p:p + width]] < i:
                    gone[p:p + width] = b"\1" * width
        left = bytes(c for c, g in zip(data, gone) if not g)
        out.append((left, sum(gone), sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))))
    return out


def contamination(texts, items, window=13):
    """For every text: words, hit words, items, digest, verdict."""
    windows = defaultdict(set)
    for name, text in items:
        words = ITEM_WORDS.findall(lower(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i:i + n])].add("null" if name is None else str(name))
    out = []
    for text in texts:
        words, hit, found = ITEM_WORDS.findall(lower(text)), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                names = windows.get(tuple(words[i:i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        out.append((len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out
