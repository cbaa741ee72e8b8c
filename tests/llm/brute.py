"""Plain versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def lm_base(rows, trains):
    tokens = [SPACE.findall(lower(t)) + [None] for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, tokens) if trains(zlib.crc32(b"" if i is None else str(i).encode())) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for ws in tokens]


def near(rows, size, percent=80):
    def shingles(t):
        w = SPACE.findall(lower(t))
        return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and (100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) or rows[a][0] is not None and rows[a][0] == rows[b][0]):
                up[root(a)] = root(b)
    group = {}
    for k, (i, _) in enumerate(rows):
        group.setdefault(root(k), []).append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in group.items()}
    return [(i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows)]


def rules(t):
    t = t or ""
    w, lines = SPACE.findall(t), [x for x in t.split("\n") if SPACE.search(x)]
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def contamination(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if i is None else str(i))
    out = []
    for t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((len(w), len(hit), sorted(found)))
    return out


def repeats(texts, least):
    """Removed flags of each text's bytes."""
    data = [(t or "").encode() for t in texts]
    c = Counter(d[i : i + least] for d in data for i in range(len(d) - least + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - least + 1):
            if c[d[i : i + least]] > 1:
                gone[i : i + least] = b"\1" * least
        out.append((d, bytes(gone)))
    return out


def repeat_digest(d, gone):
    kept = bytes(b for b, g in zip(d, gone) if not g)
    return len(d), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest()
