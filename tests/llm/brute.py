"""Plain definitions that the operators are compared with."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def removed_windows(rows, width):
    """(doc_id, n_words, n_removed, kept_sha256) by counting every window of ``width`` words."""
    split = [words(t) for _, t in rows]
    count = Counter(tuple(w[i:i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if count[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        out.append((doc_id, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def removed_bytes(rows, width):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by counting every byte string."""
    bodies = [(t or "").encode() for _, t in rows]
    count = Counter(b[i:i + width] for b in bodies for i in range(len(b) - width + 1))
    out = []
    for (doc_id, _), b in zip(rows, bodies):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if count[b[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        spans = sum(1 for s in bytes(gone).split(b"\0") if s)
        out.append((doc_id, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def similar(rows, percent=75):
    """(doc_id, n_shingles, component_id) over all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    kinds = list(dict.fromkeys(sets))
    parent = list(range(len(kinds)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    inverted = defaultdict(list)
    for i, s in enumerate(kinds):
        for t in s:
            inverted[t].append(i)
    for i, s in enumerate(kinds):
        for j, n in Counter(j for t in s for j in inverted[t] if j > i).items():
            if 100 * n >= percent * (len(s) + len(kinds[j]) - n):
                parent[find(i)] = find(j)
    at = {s: i for i, s in enumerate(kinds)}
    smallest = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            root = find(at[s])
            smallest[root] = min(smallest.get(root, doc_id), doc_id)
    return [(doc_id, len(s), smallest.get(find(at[s])) if s else doc_id) for (doc_id, _), s in zip(rows, sets)]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))
