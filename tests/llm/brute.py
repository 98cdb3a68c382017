"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def targets(sizes: dict, budget=1.5, repeats=2.0) -> dict:
    """Resharing the excess step by step."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    total, full = budget * sum(sizes.values()), set()
    while True:
        rest = total - sum(repeats * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > repeats * sizes[s]]
        if not over:
            return {s: repeats * sizes[s] if s in full else share[s] for s in order}
        full |= set(over)


def edited(rows):
    """{position: (n_chars, edited text, position of the next)} of (doc_id, text) rows."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0), rows[i][1] or ""))
    out = {}
    for k, i in enumerate(order):
        j = order[(k + 1) % len(order)]
        a, b = rows[i][1] or "", rows[j][1] or ""
        half = len(a) // 2
        out[i] = (len(a), a[:len(a) - half] + b[:half], j)
    return out


def shingles(text, size):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def near_components(rows, size):
    """{doc_id: (set size, component)} of (doc_id, text) rows with distinct ids."""
    sets = {d: shingles(t, size) for d, t in rows}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    by = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    tried = set()
    for d in sorted(sets):
        near = {e for x in sets[d] for e in by[x] if e > d}
        for e in near - tried:
            common = len(sets[d] & sets[e])
            if 100 * common >= 80 * (len(sets[d]) + len(sets[e]) - common):
                a, b = sorted((root(d), root(e)))
                up[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def nearest(ids, vectors, k=5, every=50):
    ok = [i for i, v in enumerate(vectors) if v is not None and len(v) and None not in list(v)
          and np.isfinite(np.asarray(v, float)).all() and np.any(np.asarray(v, float))]
    m = np.array([vectors[i] for i in ok], float)
    unit = m / np.sqrt((m * m).sum(axis=1, keepdims=True))
    own = np.array([ids[i] for i in ok])
    out = {}
    for i, q in zip(own, unit):
        if i % every == 0:
            cos = unit @ q
            order = [j for j in np.lexsort((own, -np.round(cos, 12))) if own[j] != i][:k]
            out[int(i)] = [(int(own[j]), float(cos[j])) for j in order]
    return out


def within(a, b, edits):
    """Whether a becomes b by at most ``edits`` edits: tries each edit at the first difference."""
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    a, b = a[k:], b[k:]
    if not a or not b or not edits:
        return max(len(a), len(b)) <= edits
    return within(a[1:], b[1:], edits - 1) or within(a[1:], b, edits - 1) or within(a, b[1:], edits - 1)


def repeated_lines(rows, min_chars, edits):
    """{doc_id: sorted numbers of distinct lines that go} of (doc_id, text) rows with distinct ids."""
    at, first = {}, {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            continue
        distinct = list(dict.fromkeys(x.strip(" \t\r") for x in text.split("\n")))
        for i, line in enumerate(distinct):
            if len(line) >= min_chars:
                at[d, i] = line
                first.setdefault(line, (d, i))
    near = set()
    lines = sorted(first, key=len)
    for i, a in enumerate(lines):
        for b in lines[i + 1:]:
            if len(b) - len(a) > edits:
                break
            if within(a, b, edits):
                near.add(max(a, b, key=lambda x: first[x]))
    out = {}
    for (d, i), line in at.items():
        if line in near or first[line] != (d, i):
            out.setdefault(d, []).append(i)
    return {d: sorted(x) for d, x in out.items()}


def repeats(rows, length=50):
    """[(n_bytes, n_removed, n_spans, kept)] of (doc_id, text) rows."""
    least = {}
    data = [((t or "").encode("utf-8")) for _, t in rows]
    for (d, _), b in zip(rows, data):
        if d is not None:
            for p in range(len(b) - length + 1):
                s = b[p:p + length]
                least[s] = min(d, least.get(s, d))
    out = []
    for (d, _), b in zip(rows, data):
        gone = np.zeros(len(b) + 1, bool)
        if d is not None:
            for p in range(len(b) - length + 1):
                if least[b[p:p + length]] < d:
                    gone[p:p + length] = True
        gone = gone[:-1]
        runs = int(np.sum(gone & ~np.concatenate(([False], gone[:-1])))) if len(b) else 0
        out.append((len(b), int(gone.sum()), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1
