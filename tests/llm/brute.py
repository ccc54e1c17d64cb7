"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def components(ids, linked):
    parent = {i: i for i in ids}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in linked:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {i: root(i) for i in ids}


def shingles(text, n=3):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1))


def ngram_join(docs, percent=90, n=3):
    sets = {i: shingles(t, n) for i, t in docs}
    linked = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    found = components(sets, linked)
    return {i: (len(sets[i]), found[i]) for i in sets}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def contamination(docs, items, window=13):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    owners = {}
    for item, text in items:
        words = word.findall((text or "").encode().lower())
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if words else 0):
            owners.setdefault(tuple(words[k : k + n]), set()).add(None if item is None else str(item))
    out = {}
    for i, text in docs:
        words, hit, found = word.findall((text or "").encode().lower()), set(), set()
        for n in {len(p) for p in owners}:
            for k in range(len(words) - n + 1):
                if (phrase := tuple(words[k : k + n])) in owners:
                    hit |= set(range(k, k + n))
                    found |= owners[phrase]
        out[i] = (len(words), len(hit), sorted(found - {None}))
    return out


def repeated_words(docs, window=50):
    words = {i: (t or "").encode().split() for i, t in docs}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out[i] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


def repeated_bytes(docs, length=100):
    data = {i: (t or "").encode() for i, t in docs}
    first = {}
    for i in sorted(data):
        for k in range(len(data[i]) - length + 1):
            first.setdefault(data[i][k : k + length], (i, k))
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < (i, k):
                gone[k : k + length] = b"\1" * length
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out
