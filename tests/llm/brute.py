"""Plain versions of the operators, for small inputs."""

import re

import numpy as np
import xxhash


def simhash(text):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(fps, distance=2):
    """Smallest id reachable by links of at most ``distance`` bits."""
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bits = np.array([fps[i] for i in ids], np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= distance) + i + 1:
            a, b = find(ids[i]), find(ids[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def top_k(vectors, queries, k):
    out = []
    for q, x in queries:
        scores = sorted((-int(np.dot(x, y)), i) for i, y in vectors if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return out


def crc32c(data):
    value = 0xFFFFFFFF
    for byte in data:
        value ^= byte
        for _ in range(8):
            value = value >> 1 ^ (0x82F63B78 if value & 1 else 0)
    return value ^ 0xFFFFFFFF


def leaks(docs, items, window=8, least=6):
    """(doc, item) pairs that share at least ``least`` windows of plain lower-case words."""
    index, sizes = {}, {}
    for i, text in items:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        sizes[i] = max(0, len(words) - window + 1)
        for k in range(sizes[i]):
            index.setdefault(tuple(words[k : k + window]), set()).add((i, k))
    found = {}
    for d, text in docs:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        for k in range(len(words) - window + 1):
            for i, at in index.get(tuple(words[k : k + window]), ()):
                found.setdefault((d, i), set()).add(at)
    return {pair for pair, ats in found.items() if len(ats) >= min(least, sizes[pair[1]])}


def spelling(docs, one_in=97, least_length=5, least=3):
    """Rows of the spelling variants, comparing all pairs of words."""
    import zlib

    n = {}
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                n[run] = n.get(run, 0) + 1
    n = {w: c for w, c in n.items() if c >= least}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if a == b or len(b) - len(a) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    around = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, xs in around.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(around[w]), n[form[w]] if form[w] else None) for w in n}


def repeats(docs, length=100):
    """Per document what stays, with a set of all strings seen so far; ``docs`` in order of their ids."""
    import hashlib

    seen, out = set(), []
    for d, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((d, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def near_copies(docs, similarity=0.8, words=5):
    """Smallest id reachable by links of a Jaccard similarity of word shingles."""
    def shingles(text):
        parts = (text or "").encode().lower().split()
        return frozenset(tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1)))

    ids = sorted(docs)
    sets = {i: shingles(docs[i]) for i in ids}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if len(a & b) >= similarity * len(a | b) and find(i) != find(j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
