"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import glob
import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.dataset as ds

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def load(name: str, directory: str = SF_DIR) -> list[dict]:
    return ds.dataset(f"{directory}/{name}.parquet").to_table().to_pylist()


def words(text) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def secrets(text) -> tuple[int, int, int, str]:
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    kinds = Counter(k for _, k, _ in found)
    told = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))
    return kinds[0], kinds[1], kinds[2], told


def quality(text) -> dict:
    w = words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "base_failed": len(w) < 20 or 100 * len(inside) > 30 * len(w),
    }


def targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """Share all sizes by weight; cap; share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def url_parts(url) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = re.search(r"[/?#]|$", rest).start()
    return lower(rest[:cut]), re.match(r"[^?#]*", rest[cut:])[0]


URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def url_rule(host: str, path: str) -> tuple[str, str] | None:
    fits = []
    for rule, verdict in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else None


def shingles(text, k: int) -> set:
    w = words(lower(text))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def components(sets: dict, percent: int) -> dict:
    """The smallest id reachable over links of 100 * intersection >= percent * union."""
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    shared = Counter()
    for ids in holders.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                shared[min(a, b), max(a, b)] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: root(d) for d in sets}


def repeats(texts: dict, size: int = 100) -> dict:
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of what stays)."""
    first, out = {}, {}
    data = {d: (texts[d] or "").encode() for d in sorted(texts)}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first.setdefault(b[i : i + size], (d, i)) != (d, i):
                gone[i : i + size] = b"\x01" * size
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


def crc(text) -> int:
    return zlib.crc32((text or "").encode())
