import zlib
from array import array

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vaultflow.llm import packing, token_counts
from vaultflow.llm.tokens import default_tokenizer_path, encoder


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer_path())


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


PIECES = st.sampled_from([" ", "  ", "\n", "\t", " ", " ", "\x1c", "a", "the", "Don't", "'s", "'", "12", "é", "日本", "😀", ".", "...", "<|endoftext|>", "x_y", "\x00"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_ids_are_the_tokenizers(text):
    t = Tokenizer.from_file(default_tokenizer_path()) if not hasattr(test_ids_are_the_tokenizers, "t") else test_ids_are_the_tokenizers.t
    test_ids_are_the_tokenizers.t = t
    assert list(array("I", encoder().encode_bytes(text))) == ids(t, text)


def test_counts(spark, rows, docs, nothing, tokenizer, sf):
    n = sorted(len(ids(tokenizer, t)) for _, t in rows)
    got = {r["length"]: r for r in token_counts.op10_token_counts(spark, sf(rows)).collect()}
    assert sorted(got) == sorted(set(n))
    for k, r in got.items():
        assert (r["n_docs"], r["n_tokens"]) == (n.count(k), k * n.count(k))
        assert (r["docs_within"], r["docs_longer"]) == (sum(x <= k for x in n), sum(x > k for x in n))
        assert (r["tokens_within"], r["tokens_longer"], r["truncated_tokens"]) == (sum(x for x in n if x <= k), sum(x for x in n if x > k), sum(min(x, k) for x in n))
    sums = token_counts.suffix_sums(token_counts.length_histogram(token_counts.encoded_lengths(docs)))
    for r in token_counts.at_limits(sums, [0, 10, 333, 10**6]).collect():
        assert (r["n_docs"], r["n_tokens"], r["truncated_tokens"], r["docs_longer"]) == (len(n), sum(n), sum(min(x, r["limit"]) for x in n), sum(x > r["limit"] for x in n))
    for q in (0.01, 0.5, 0.9, 1.0):
        assert token_counts.quantile(sums, q) == next(x for i, x in enumerate(n, 1) if i >= q * len(n) - 1e-9)
    empty = token_counts.suffix_sums(token_counts.length_histogram(token_counts.encoded_lengths(nothing)))
    assert empty.count() == 0 and token_counts.quantile(empty, 0.5) is None
    assert token_counts.at_limits(empty, [5]).first()["truncated_tokens"] == 0


def simple_best_fit(lengths, capacity):
    bins = []
    for x in sorted(lengths, reverse=True):
        fit = [i for i, left in enumerate(bins) if left >= x]
        if fit:
            bins[min(fit, key=lambda i: bins[i])] -= x
        else:
            bins.append(capacity - x)
    return sorted(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_runs_are_best_fit_decreasing(lengths):
    runs, n = packing.best_fit_decreasing({x: lengths.count(x) for x in set(lengths)}, 20)
    used, cells = {}, set()
    for r in runs:
        for k in range(r.count):
            s, at = r.sequence + k // r.per_bin, r.offset + k % r.per_bin * r.length
            used[s] = used.get(s, 0) + r.length
            new = {(s, p) for p in range(at, at + r.length)}
            assert not new & cells
            cells |= new
    assert sum(r.count for r in runs) == len(lengths) and len(used) == n
    assert sorted(20 - x for x in used.values()) == simple_best_fit(lengths, 20)


def test_packing(spark, rows, tokenizer, sf):
    from collections import Counter

    got = packing.op3_pack(spark, sf(rows)).collect()
    want = Counter()
    for i, t in rows:
        x = ids(tokenizer, t) + [0]
        first = (len(x) - 1) % 2048 + 1
        at, k = 0, 0
        while at < len(x):
            n = first if not at else 2048
            want[i, k, at, n, zlib.crc32(array("I", x[at : at + n]).tobytes())] += 1
            at, k = at + n, k + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for x in by.values():
        at = 0
        for offset, n in sorted(x):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(by) == len(simple_best_fit([r["length"] for r in got], 2048))


def test_packing_keeps_ids_and_takes_nothing(spark, docs, nothing, tokenizer):
    assert packing.pack(nothing).count() == 0
    out = packing.pack(docs, capacity=64, keep_ids=True)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out.filter("doc_id IN (7, 13, 120)").collect():
        whole = ids(tokenizer, text[r["doc_id"]]) + [0]
        assert r["ids"] == whole[r["start"] : r["start"] + r["length"]]
