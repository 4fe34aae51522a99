"""Brute-force versions that the tests share."""

import hashlib
import re

import xxhash

from vaultflow.llm._common import LOWER


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def components_of(ids, prints, radius):
    """ids in ascending order, nulls last."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(len(prints)):
                if label[j] < label[i] and (prints[i] ^ prints[j]).bit_count() <= radius:
                    label[i] = label[j]
                    changed = True
    return [ids[k] for k in label]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def contamination(rows, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if i is None else str(i))
    out = {}
    for i, t in rows:
        w, found = words(t), set()
        hit = [0] * len(w)
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    found |= windows[x]
                    hit[k : k + n] = [1] * n
        out[i] = (len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0)
    return out


def matches(rows):
    lines = sorted((i, n, frozenset(x.split())) for i, t in rows if i is not None for n, x in enumerate((t or "").encode().translate(LOWER).split(b"\n")) if x.split())
    out = {}
    for k, (i, n, s) in enumerate(lines):
        out[i, n] = next(((j, m) for j, m, o in lines[:k] if 5 * len(s & o) >= 4 * len(s | o)), None)
    return out
