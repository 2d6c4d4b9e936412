"""Plain single-process versions of what the operators compute, for small inputs."""

import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SPACE.split(low) if w]


def shingles(text, k=5):
    w = words(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def near_components(rows, percent):
    """doc_id -> (set size, component), every pair compared that shares a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    for d, s in sets.items():
        common = {}
        for x in s:
            for e in where[x]:
                if e < d:
                    common[e] = common.get(e, 0) + 1
        for e, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def repeats(rows, k=50):
    """doc_id -> covered byte flags: bytes of k-byte strings that also start in a document of a smaller id."""
    first = {}
    texts = {d: (t or "").encode() for d, t in rows}
    for d in sorted(texts):
        b = texts[d]
        for i in range(len(b) - k + 1):
            first.setdefault(b[i : i + k], d)
    out = {}
    for d, b in texts.items():
        flags = bytearray(len(b))
        for i in range(len(b) - k + 1):
            if first[b[i : i + k]] < d:
                flags[i : i + k] = b"\x01" * k
        out[d] = flags
    return out


def edit_in(item, text):
    """Least edit distance of the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(last + (c != t), row[j] + 1, row[j - 1] + 1)
    return min(row)
