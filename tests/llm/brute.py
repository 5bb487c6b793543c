"""Brute-force versions of what the contracts ask for, in plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def held_out(i, m, r):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m == r


def leaks(docs, items, n=10):
    own = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").encode().lower())
        for j in range(max(1, len(w) - n + 1)):
            if w:
                own[tuple(w[j : j + n])] |= set() if item is None else {str(item)}
    lengths, out = {len(k) for k in own}, []
    for i, text in docs:
        w = ALNUM.findall((text or "").encode().lower())
        hit, ids = [False] * len(w), set()
        for k in lengths:
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in own:
                    hit[j : j + k] = [True] * k
                    ids |= own[tuple(w[j : j + k])]
        out.append((i, len(w), sum(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), any(hit)))
    return out


def components(docs, size=3, num=90, den=100):
    sets = []
    for i, text in docs:
        w = words(text, True)
        sets.append((i, {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())))
    up = {i: i for i, _ in sets if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if a and b and i is not None and j is not None and den * len(a & b) >= num * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else top(i)) for i, s in sets]


def base_scores(docs, learn):
    tokens = [(i, [*words(t, True), None]) for i, t in docs]
    c = Counter(w for i, ts in tokens if learn(i) for w in ts)
    n, v = sum(c.values()), len(c)
    return [(i, not learn(i), len(ts), sum(c[w] > 0 for w in ts), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ts)) for i, ts in tokens]


def without_repeats(docs, window=35, keep_first=False):
    """``keep_first``: a window stays where it occurs first, in the order of ``docs``."""
    seen, met = Counter(), set()
    texts = [(i, words(t)) for i, t in docs]
    for _, w in texts:
        for j in range(len(w) - window + 1):
            seen[tuple(w[j : j + window])] += 1
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            if seen[key] > 1 and not (keep_first and key not in met):
                gone[j : j + window] = [True] * window
            met.add(key)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), kept.decode()))
    return out


def payload(text):
    b = (text or "").encode()
    return b, b + b" " * (192 if not b else -len(b) % 192)


def mixed_sizes(rows, weights=(3, 1, 2), budget=1.5, epochs=2):
    """Targets by source, by sharing out again and again."""
    size = Counter()
    for s, n in rows:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = budget * sum(size.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > epochs * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = float(epochs * size[s])
            left -= target[s]
        open_ -= over
    return size, target


def repeated_bytes(docs, width):
    """Per document: bytes, removed bytes, removed runs, digest of the rest."""
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[j : j + width] for _, b in texts for j in range(len(b) - width + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for j in range(len(b) - width + 1):
            if seen[b[j : j + width]] > 1:
                gone[j : j + width] = b"\1" * width
        runs = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def clusters(rows, k=16, rounds=3, scale=64, size=64):
    """Lloyd's rounds in whole numbers: vector id, cluster, distance, and the final centroids."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(x)) for x in v]))
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), j) for j, p in enumerate(points))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        points = [[sum(c) // len(own[j]) for c in zip(*own[j], strict=True)] if own[j] else p for j, p in enumerate(points)]
    return [(i, *nearest(v)[::-1]) for i, v in kept], points


def trie(rows, borrowed=9, family=5):
    """Nodes of the rebuilt conversations; turns of one number must be equal or not occur."""
    turns = defaultdict(list)
    for c, at, role, text in rows:
        if c is not None:
            turns[c].append(((at is not None, at or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x)] for c, x in turns.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % borrowed
        whole[c] = tuple(own.get(c - int(math.fmod(c, family)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, p in whole.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    out = []
    for key, who in members.items():
        below = [k for k in members if k[: len(key)] == key]
        parents = {k[:-1] for k in members if k}
        saved = sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k)
        ends = ",".join(str(c) for c in sorted(who) if len(whole[c]) == len(key))
        out.append((min(who), len(key), min(members[key[:-1]]) if key else None, len(who), sum(len(k) == len(key) + 1 for k in below), sum(k not in parents for k in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out
