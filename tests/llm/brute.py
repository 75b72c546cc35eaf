"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def secrets(text: str | None):
    """n_assign, n_access, n_hex, base_sha256 and the base spans."""
    text = text or ""
    kinds = [
        [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 12],
        [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= 18],
        [m.span() for m in HEX.finditer(text) if len(m[0]) >= 16],
    ]
    names = ("assign", "access", "hex")
    spans = sorted((a, k, b) for k, found in enumerate(kinds) for a, b in found)
    told = [f"{names[k]}:{a}:{b}" for a, k, b in spans]
    return (*map(len, kinds), sha(",".join(told))), told


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def superkmer(rows, k: int = 13):
    """rows: (doc_id, text); per row n_words, n_removed, kept hash."""
    first: dict[tuple, int] = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            at = doc if doc is not None else 2**63 - 1
            first[key] = min(first.get(key, at), at)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < (doc if doc is not None else 2**63 - 1):
                gone[i : i + k] = [True] * k
        out.append((doc, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def bwt(rows, length: int = 400):
    count: Counter = Counter()
    for _, text in rows:
        raw = (text or "").encode()
        count.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if count[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc, len(raw), int(gone.sum()), spans, sha(np.frombuffer(raw, np.uint8)[~gone].tobytes())))
    return out


def bag(text: str | None, k: int = 5) -> Counter:
    w = words(text)
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def jaccard(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / sum((a | b).values())


def groups(nodes, links):
    """Least member of each node's component."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_links(bags: dict, threshold: float = 0.8):
    """All pairs of keys whose multisets are similar enough, by an index of shingles."""
    at = defaultdict(list)
    for key, b in bags.items():
        for s in b:
            at[s].append(key)
    shared: Counter = Counter()
    for keys in at.values():
        for i, a in enumerate(keys):
            for b in keys[i + 1 :]:
                shared[(a, b)] += 1
    return [(a, b) for a, b in shared if jaccard(bags[a], bags[b]) >= threshold]


def usable(v) -> bool:
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def cosine_links(rows, threshold: float = 0.95):
    good = [(i, np.array(v, float)) for i, v in rows if usable(v)]
    out = []
    for n, (i, v) in enumerate(good):
        for j, w in good[n + 1 :]:
            if len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                out.append((i, j))
    return out


def nearest(rows, k: int = 20):
    good = [(i, np.array(v, float)) for i, v in rows if usable(v)]
    out = {}
    for i, v in good:
        if i % 20 == 0:
            scores = sorted((-float(np.einsum("d,d->", v, w)), j) for j, w in good if j != i and len(v) == len(w))
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out
