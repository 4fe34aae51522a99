"""Secret scans: pattern rules, and sliding-window Shannon entropy per character class over
candidate strings, computed by incremental counts, with allow-list suppression.

Defined results: a null or empty text has no spans; repeated rows are scanned one by one; null
ids pass through; an empty table gives no rows; other columns are never read. Positions are code
points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from vaultflow.llm._common import id_type, map_batches, read_table, schema_of, texts_of

KINDS = ("assign", "access", "hex", "entropy")

ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24
ACCESS = re.compile(rb"AKIA[A-Z0-9]{%d,}" % (MIN_ACCESS - 4))


class CharClass(NamedTuple):
    """Candidates are runs of these bytes; a window of them is suspect from an entropy of bits on, if it has two letters and so many digits."""

    name: str
    alphabet: bytes
    window: int
    bits: float
    digits: int = 2


_LOWER, _UPPER, _DIGIT = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"

#: Windows of random characters reach 3.3 (hex), 3.8 and 3.8 bits nearly always. Of random base64 strings of 20 characters 97 in 100 are found, of 40 all but 1 in 500.
CLASSES = (
    CharClass("hex", _DIGIT + b"abcdefABCDEF", 24, 3.1),
    CharClass("upper", _UPPER + _DIGIT, 20, 3.5),
    CharClass("base64", _LOWER + _UPPER + _DIGIT + b"+/_-", 20, 3.6, 1),
)

#: What looks random and is no secret. A span that one of them covers is dropped.
ALLOW = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"(?i:[a-z0-9+/_-]*(?:example|sample|dummy|placeholder|changeme)[a-z0-9+/_-]*)",
    r"(?:0123456789|1234567890|abcdefghij|ABCDEFGHIJ)[0-9A-Za-z]*",
    r"(?:https?|ftp)://[^\s\"'<>]*",
    r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+",
)


def _membership(alphabet: bytes) -> bytes:
    return bytes(120 if b in alphabet else 32 for b in range(256))


_MASKS = {c.name: _membership(c.alphabet) for c in CLASSES}
_HEX_MASK = _membership(_DIGIT + b"abcdef")


def _runs(masked: bytes, least: int):
    """Maximal runs of x of least length."""
    needle, at = b"x" * least, 0
    while (start := masked.find(needle, at)) >= 0:
        end = masked.find(b" ", start)
        at = len(masked) if end < 0 else end
        yield start, at


def entropy_spans(candidate: bytes, window: int, bits: float, least_digits: int = 2) -> list[tuple[int, int]]:
    """Unions of the windows of an entropy of bits or more, which have two letters and least_digits digits.

    The sum of c*log2(c) over the window's counts changes by two counts for each step."""
    gain = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]  # the next byte comes before the last one goes
    most = window * (math.log2(window) - bits) + 1e-9
    counts, total, digits, letters, spans = [0] * 256, 0.0, 0, 0, []
    for i, b in enumerate(candidate):
        c = counts[b]
        counts[b] = c + 1
        total += gain[c + 1] - gain[c]
        digits += 48 <= b <= 57
        letters += 65 <= b <= 90 or 97 <= b <= 122
        if i >= window:
            old = candidate[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += gain[c - 1] - gain[c]
            digits -= 48 <= old <= 57
            letters -= 65 <= old <= 90 or 97 <= old <= 122
        if i >= window - 1 and total <= most and digits >= least_digits and letters > 1:
            start = i - window + 1
            if spans and spans[-1][1] >= start:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(points: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the pattern rules; points has a byte for each code point."""
    out = []
    low = points.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(points) if m.end(1) - m.start(1) >= MIN_ASSIGNED]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(points)]
    out += [(s, e, 2) for s, e in _runs(points.translate(_HEX_MASK), MIN_HEX)]
    return sorted(out, key=lambda x: (x[0], x[2]))


def scan_text(text: str, classes=CLASSES, allow=ALLOW) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The pattern rules' spans, and those of the entropy scan that the allow-list leaves."""
    points = text.encode("latin-1", "replace")
    base = base_spans(points)
    found = []
    for c in classes:
        for start, end in _runs(points.translate(_MASKS[c.name]), c.window):
            found += [(start + s, start + e) for s, e in entropy_spans(points[start:end], c.window, c.bits, c.digits)]
    if not found:
        return base, []
    merged = []
    for s, e in sorted(found):
        if merged and merged[-1][1] >= s:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    allowed = [m.span() for p in _compiled(tuple(allow)) for m in p.finditer(text)]
    return base, [(s, e, 3) for s, e in merged if not any(a <= s and e <= z for a, z in allowed)]


_PATTERNS: dict[tuple, list] = {}


def _compiled(allow: tuple[str, ...]) -> list[re.Pattern]:
    if allow not in _PATTERNS:
        _PATTERNS[allow] = [re.compile(x) for x in allow]
    return _PATTERNS[allow]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame, classes=CLASSES, allow=ALLOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, base and added, its spans as arrays of (start, end, kind) flattened."""

    def run(batches):
        for b in batches:
            found = [scan_text(x, classes, allow) for x in b.column(1).to_pylist()]
            yield {"doc_id": b.column(0), "base": [[v for s in x for v in s] for x, _ in found], "added": [[v for s in x for v in s] for _, x in found]}

    return map_batches(texts_of(docs, id_col, text_col), run, schema_of(f"doc_id {id_type(docs, id_col)}, base array<bigint>, added array<bigint>"))


def redact(docs: DataFrame, mark: str = "[SECRET]", classes=CLASSES, allow=ALLOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with mark in place of each union of spans; null texts stay null, all columns stay."""
    at = docs.columns.index(text_col)

    def clean(text):
        if text is None:
            return None
        base, added = scan_text(text, classes, allow)
        out, last = [], 0
        for s, e, _ in sorted(base + added):
            if s >= last:
                out += [text[last:s], mark]
            last = max(last, e)
        return "".join([*out, text[last:]])

    def run(batches):
        for b in batches:
            yield {f.name: [clean(x) for x in b.column(i).to_pylist()] if i == at else b.column(i) for i, f in enumerate(b.schema)}

    return map_batches(docs, run, docs.schema)


def _unflat(x: list[int]) -> list[tuple[int, int, int]]:
    return list(zip(x[::3], x[1::3], x[2::3]))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")

    def run(batches):
        for b in batches:
            base = [_unflat(x) for x in b.column(1).to_pylist()]
            added = [_unflat(x) for x in b.column(2).to_pylist()]
            yield {
                "doc_id": b.column(0),
                **{f"n_{k}": [sum(s[2] == i for s in x) for x in base] for i, k in enumerate(KINDS[:3])},
                "base_sha256": [hashlib.sha256(joined(x).encode()).hexdigest() for x in base],
                "spans": [joined(sorted(x + y, key=lambda s: (s[0], s[2]))) for x, y in zip(base, added)],
                "n_entropy": [len(x) for x in added],
            }

    return map_batches(scan(docs), run, schema_of(f"doc_id {id_type(docs, 'doc_id')}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_entropy bigint"))
