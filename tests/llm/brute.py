"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np

GAP = re.compile("[\x20\x09-\x0d]+")

LONG = " ".join(f"w{i * i % 9973}" for i in range(40_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))


def low(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def words(text):
    return [w for w in GAP.split(low(text)) if w]


def runs(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def remainder(key, by):
    return zlib.crc32(str(key).encode()) % by


def links(rows, threshold=0.8):
    """(doc_id, text) rows: pairs of positions whose sets of runs are similar."""
    sets = [runs(t) for _, t in rows]
    where = collections.defaultdict(set)
    for i, s in enumerate(sets):
        for r in s:
            where[r].add(i)
    out = set()
    for i, s in enumerate(sets):
        for j in {j for r in s for j in where[r] if j > i}:
            shared = len(s & sets[j])
            if shared >= threshold * (len(s) + len(sets[j]) - shared):
                out.add((i, j))
    return out


def groups(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def cut(texts, length=200):
    """Bytes kept, bytes removed and runs removed of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.defaultdict(list)
    for d, r in enumerate(raw):
        for p in range(len(r) - length + 1):
            seen[hashlib.md5(r[p : p + length]).digest()].append((d, p))
    gone = [np.zeros(len(r), bool) for r in raw]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places:
                gone[d][p : p + length] = True
    return [
        (bytes(np.frombuffer(r, np.uint8)[~g]), int(g.sum()), int((np.diff(np.r_[0, g.astype(int)]) == 1).sum()))
        for r, g in zip(raw, gone, strict=True)
    ]


def cut_characters(texts, length=200):
    """What is left of each text if a character goes only with all its bytes."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[p : p + length] for r in raw for p in range(len(r) - length + 1))
    out = []
    for t, r in zip(texts, raw, strict=True):
        gone = np.zeros(len(r), bool)
        for p in range(len(r) - length + 1):
            if seen[r[p : p + length]] > 1:
                gone[p : p + length] = True
        at, kept = 0, []
        for c in t or "":
            size = len(c.encode())
            if not gone[at : at + size].all():
                kept.append(c)
            at += size
        out.append("".join(kept))
    return out


def contained(docs, items, threshold=0.8, size=5):
    """(doc_id, item_id) -> containment; items of fewer words are found as a row of words."""
    held = {i: (words(t), runs(t)) for i, t in items}
    out = {}
    for d, text in docs:
        s, line = runs(text), f" {' '.join(words(text))} "
        for i, (w, r) in held.items():
            if 0 < len(w) < size:
                if f" {' '.join(w)} " in line:
                    out[d, i] = 1.0
            elif r and len(r & s) >= threshold * len(r):
                out[d, i] = len(r & s) / len(r)
    return out


def bm25(rows, queries, k=10):
    """query position -> (score, doc_id) of the best rows."""
    def terms(text):
        plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text or "")
        return collections.Counter(re.findall("[0-9a-z\u0080-\U0010ffff]+", plain))

    bags = [terms(t) for _, t in rows]
    sizes = [sum(b.values()) for b in bags]
    n, average = len(rows), max(1, sum(sizes) / len(rows))
    df = collections.Counter(w for b in bags for w in b)
    out = {}
    for q in queries:
        scores = collections.Counter()
        for w, qtf in bags[q].items():
            idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
            for j, b in enumerate(bags):
                if w in b:
                    scores[j] += qtf * idf * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * sizes[j] / average))
        out[q] = sorted(((-s, rows[j][0]) for j, s in scores.items()), key=lambda x: (round(x[0], 4), x[1] is None, x[1] or 0))[:k]
    return out


def lines_kept(rows, least=10):
    """(doc_id, text) rows: lines, lines dropped, and text kept of each; a null id counts as the last document."""
    def key(line):
        return line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate({i: i + 32 for i in range(65, 91)})

    rank = lambda d: (d is None, d or 0)
    where = collections.defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                where[key(line)].add(rank(d))
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or min(where[key(x)]) == rank(d)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def negatives(rows, anchors, positives=5, negatives=3):
    """(id, components or None, label) rows: the mined pairs, by exact arithmetic."""
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    rows = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if y is not None and ok(v)]
    rank = lambda d: (d is None, d or 0)
    out = []
    for n, (i, v, y) in enumerate(rows):
        if not anchors(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j, z == y) for m, (j, w, z) in enumerate(rows) if m != n]
        scored.sort(key=lambda s: (-s[0], rank(s[1])))
        for score, j, _ in [s for s in scored if s[2]][:positives]:
            fitting = [s for s in scored if not s[2] and 50 * score <= 100 * s[0] <= 95 * score][:negatives]
            out += [(i, j, k, s[1], score, s[0]) for k, s in enumerate(fitting, 1)]
    return out


def periodic(words):
    """All runs (start, length, smallest period), lag by lag."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q):
                part = words[start : start + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((start, length, q))
            i = j + 1
    return sorted(out)


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)
