import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tests_llm_helpers import components_of, contamination, fingerprint, lower, matches, words

from vaultflow.llm import components, decontamination, fingerprints, line_dedup, lm_scoring, simhash


def test_simhash(spark, rows, sf):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [fingerprint(t) for _, t in ordered]
    want = {i: (f"{p:016x}", c) for (i, _), p, c in zip(ordered, prints, components_of([i for i, _ in ordered], prints, 2))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op7_simhash(spark, sf(rows)).collect()}
    assert got == want


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_distances(radius):
    r = np.random.default_rng(radius)
    base = r.integers(0, 2**63, 30, dtype=np.uint64)
    x = np.concatenate([base, base ^ (np.uint64(1) << r.integers(0, 63, 30, dtype=np.uint64)), base[:10] ^ np.uint64(0b1110001)])
    near = np.unpackbits(simhash.within(simhash.planes_of(x), x, radius).view(np.uint8), axis=1, bitorder="little")[:, : len(x)].astype(bool)
    assert (near == (np.bitwise_count(x[:, None] ^ x[None, :]) <= radius)).all()


def test_large_buckets_are_dealt_again(spark):
    r = np.random.default_rng(3)
    prints = [int(x) for x in r.integers(0, 2**20, 300)] + [int(x) for x in r.integers(0, 2**62, 50)]
    prints = sorted(set(prints) | {p ^ 0b101 for p in prints[:60]})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = dict(zip(prints, components_of(prints, prints, 2)))
    for most in (4, 2048):
        found = {x["node"]: x["root"] for x in components.connected_components(simhash.links(df, 2, most)).collect()}
        assert {p: found.get(p, p) for p in prints} == want


def test_components_of_a_path_and_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.connected_components(chain).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}
    assert components.connected_components(chain.limit(0)).count() == 0


def test_keep_one(spark, docs, nothing):
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({c for i, c in groups.items() if i == c and i is not None})
    odd = spark.createDataFrame([(1, "first text of the id one", 7), (1, "quite another text that shares its id", 8), (3, "first text of the id one", 9), (3, "quite another text that shares its id", 10), (3, "and a third one of its own", 11), (None, "first text of the id one", 12)], "doc_id long, text string, own_id int")
    left = simhash.keep_one_of_each(odd)
    assert left.columns == odd.columns and sorted(r["own_id"] for r in left.collect()) == [7, 8, 11, 12]
    twice = docs.unionByName(docs)
    assert simhash.keep_one_of_each(twice).filter("doc_id IS NOT NULL").count() == kept.filter("doc_id IS NOT NULL").count()
    assert simhash.keep_one_of_each(nothing).count() == 0


def items_for(rows):
    text = dict(rows)
    long = [t.split() for i, t in rows if t and len(t.split()) > 60]
    return [(1, " ".join(long[0][5:40])), (2, " ".join(long[1][:12]).upper()), (3, "Two words"), (4, None), (5, ""), (6, "nothing of this is anywhere in the documents at all but here"), (1, " ".join(long[2][3:25])), (7, text[7]), (None, " ".join(long[3][:11]))]


def test_decontamination(spark, rows, docs, sf):
    items = items_for(rows)
    want = contamination(rows, items)
    got = {r["doc_id"]: tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in decontamination.op4_decontamination(spark, sf(rows, benchmark=(items, "item_id long, text string"))).collect()}
    assert got == want and any(x[4] for x in want.values())
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = {r["doc_id"]: decontamination.n_hit(r["spans"]) for r in decontamination.find(docs, bench, block_words=20).collect()}
    assert blocks == {i: x[1] for i, x in want.items()}
    longest = {}
    for i, t in rows:
        w, best = words(t), (0, None, None, None)
        for item, x in ((("" if k is None else str(k)), words(y)) for k, y in items):
            n = min(10, len(x))
            for p in range(len(x) - n + 1) if n else ():
                for a in range(len(w) - n + 1):
                    m = next((m for m in range(min(len(x) - p, len(w) - a) + 1) if m == min(len(x) - p, len(w) - a) or w[a + m] != x[p + m]))
                    if m >= n and (not best[0] or (-m, item, p, a) < (-best[0], *best[1:])):
                        best = (m, item, p, a)
        longest[i] = best
    for size in (20, 1_000_000):
        found = {r["doc_id"]: tuple(r[c] for c in ("longest", "longest_item", "longest_item_start", "longest_start")) for r in decontamination.find(docs, bench, block_words=size).collect()}
        assert found == longest and any(x[0] > 10 for x in found.values())
    kept = decontamination.remove_contaminated(docs, bench, block_words=20)
    assert kept.columns == docs.columns and sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(i) for i, x in want.items() if not x[4])


def test_decontamination_edges(spark, docs, nothing):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontamination.find(nothing, bench).count() == 0
    assert decontamination.remove_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert decontamination.find(docs, bench.limit(0)).filter("n_words > 0").count() > 0


def test_longest_matches(spark, rows):
    some = [(i, t) for i, t in rows if i is not None and t][:40]
    bench = [(1, " ".join(some[0][1].split()[2:30]) + " unheard of"), (2, " ".join(some[3][1].split()[:9]))]
    got = {(r["item_id"], r["item_start"]): r["n_words"] for r in decontamination.longest_matches(spark.createDataFrame(some, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"), 4).collect()}
    want = {}
    for i, t in bench:
        w = words(t)
        for p in range(len(w)):
            best = max(next((n for n in range(len(w) - p, 0, -1) if any(d[k : k + n] == w[p : p + n] for k in range(len(d) - n + 1))), 0) for d in (words(x) for _, x in some))
            if best >= 4:
                want[str(i), p] = best
    assert got == want


def paragraphs_of(text):
    """Lines, cut after words whose CRC-32 is divisible by 8; with how often each has stood before."""
    found, seen = set(), Counter()
    for line in text.split("\n"):
        parts, now = [], []
        for w in line.split(" "):
            now.append(w)
            if zlib.crc32(w.encode()) % 8 == 0:
                parts.append(" ".join(now))
                now = []
        for x in [*parts, " ".join(now)] if now else parts:
            if x.encode().strip():
                found.add((x, seen[x]))
                seen[x] += 1
    return found


def test_fingerprints(spark, rows, docs, nothing, sf):
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    text = [t for _, t in ordered]
    sets = paragraphs_of
    like = lambda a, b: 2 * len(sets(a) & sets(b)) / (len(sets(a)) + len(sets(b))) if sets(a) or sets(b) else 1.0
    got = {r["doc_id"]: r for r in fingerprints.op5_fingerprints(spark, sf(rows)).collect()}
    assert len(got) == len(rows)
    prints = {}
    for k, (i, t) in enumerate(ordered):
        following = text[(k + 1) % len(text)]
        n = len(t) // 4
        changed = t[: len(t) - n] + following[:n]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(like(t, changed)) and r["near_next"] == pytest.approx(like(t, following))
        for x, p in ((t, r["fingerprint"]), (changed, r["edited_fingerprint"])):
            assert prints.setdefault(x, p) == p
            size, sketch = fingerprints.parsed(p)
            assert size == len(sets(x)) and (sketch.count.sum() == 3 * size)
    assert fingerprints.with_next(nothing, fingerprints.with_edits, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double").count() == 0
    assert fingerprints.fingerprint_texts(docs).count() == docs.count()


def test_repeated_short_paragraphs_have_digests_of_their_own():
    text = "\n".join(["a", "b", "c", "d"] * 300 + ["ab"] * 50)
    assert len(fingerprints.digests(text)) == 1250


def test_sketches_recover_differences():
    r = np.random.default_rng(5)
    pools = [r.integers(1, 2**63, k, dtype=np.uint64) for k in (0, 1, 5, 60, 900)]
    a = [np.unique(np.concatenate([p, q])) for p in pools for q in pools]
    b = [np.unique(np.concatenate([p, r.integers(1, 2**63, 7, dtype=np.uint64)])) for p in pools for _ in pools]
    for (only_a, only_b), x, y in zip(fingerprints.differences(a, b), a, b):
        assert set(only_a.tolist()) == set(x.tolist()) - set(y.tolist()) and set(only_b.tolist()) == set(y.tolist()) - set(x.tolist())


def test_lm_counts_and_distribution(spark, rows, sf):
    got = {r["doc_id"]: r for r in lm_scoring.op6_lm_scoring(spark, sf(rows)).collect()}
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None] for i, t in rows}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(w in count for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert np.isfinite(r["score"]) and r["score"] <= 0
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_every_state_is_a_distribution(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t in rows if i is not None], "doc_id long, text string")
    cut = lm_scoring.materialise(lm_scoring.blocks(docs, 500), "blocks")
    counts = lm_scoring.word_counts(cut)
    known = counts.toPandas()
    totals = lm_scoring.Totals(int(known.n.sum()), len(known), lm_scoring.DISCOUNT)
    tree = lm_scoring.grow(cut, counts, totals, share=1e-4, divergence=0.01)
    words, n = known.word.to_numpy(np.int64), known.n.to_numpy(np.int64)
    assert len(tree.levels) > 1 and any(k.any() for k in tree.kept)
    every, c = np.append(words, -12345), np.append(n, 0)
    contexts = [tree.words[i : i + 1] for i in np.flatnonzero(tree.kept[0])[:10]] + [tree.words[[k >> 32, k & 0xFFFFFFFF]] for k in tree.levels[0].keys[tree.kept[1]][:10]] if len(tree.kept) > 1 else []
    for context in [np.empty(0, np.int64), *contexts]:
        k = len(context)
        tokens = np.concatenate([np.append(context, w) for w in every])
        starts = np.arange(0, len(tokens), k + 1)
        p = lm_scoring.token_scores(tree, totals, tokens, starts, np.concatenate([np.append(np.full(k, 1), x) for x in c]))
        assert (10.0 ** p[k :: k + 1]).sum() == pytest.approx(1.0)


def test_lm_edges(spark, docs, nothing):
    assert lm_scoring.score(nothing).count() == 0
    small = lm_scoring.score(docs, block_tokens=50)
    large = lm_scoring.score(docs)
    a, b = ({r["doc_id"]: r for r in x.collect()} for x in (small, large))
    assert all(a[i]["score"] == pytest.approx(b[i]["score"]) and a[i]["n_known"] == b[i]["n_known"] for i in a)
    c = {r["doc_id"]: r["score"] for r in lm_scoring.score(docs, passes=3).collect()}
    assert c == pytest.approx({i: r["score"] for i, r in b.items()})
    one = spark.createDataFrame([(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0], "doc_id long, text string")
    assert {(r["n_known"], r["base_score"], r["score"]) for r in lm_scoring.score(one).collect()} == {(0, 0.0, 0.0)}


def test_lm_keeps_what_recurs_however_large_the_table(spark, rows):
    """Over 200 000 tokens a share of them is more than two occurrences. Every score is that of the whole tree in one place."""
    r = np.random.default_rng(1)
    filler = [(1000 + i, " ".join(f"w{k}" for k in r.integers(0, 3000, 3000))) for i in range(110)]
    docs = spark.createDataFrame([*rows, *filler, *((5000 + i, "seldom seen pair of words") for i in range(4))], "doc_id long, text string").repartition(4)
    cut = lm_scoring.materialise(lm_scoring.blocks(docs, 40_000), "blocks")
    counts = lm_scoring.word_counts(cut)
    n, v = (int(x) for x in counts.selectExpr("sum(n)", "count(*)").first())
    assert n > 300_000
    totals = lm_scoring.Totals(n, v, lm_scoring.DISCOUNT)
    tree, known = lm_scoring.grow(cut, counts, totals, share=0.0), {x["word"]: x["n"] for x in counts.collect()}
    want = {}
    for b in cut.collect():
        tokens, _, starts = lm_scoring._tokens(bytes(b["tokens"]), b["words"], b["sizes"])
        each = lm_scoring.token_scores(tree, totals, tokens, starts, np.array([known.get(x, 0) for x in tokens.tolist()]))
        want |= dict(zip(b["ids"], np.add.reduceat(each, starts)))
    got = {x["doc_id"]: x["score"] for x in lm_scoring.score(docs, block_tokens=40_000).collect()}
    assert got == pytest.approx(want)


def test_discard(spark):
    one, two, three = (lm_scoring.materialise(spark.range(i, i + 3), "some") for i in (0, 3, 6))
    lm_scoring.discard(one.union(two).select("id"))
    gone = [x.inputFiles()[0].removeprefix("file://") for x in (one, two)]
    assert not any(os.path.exists(x) for x in gone) and sorted(r[0] for r in three.collect()) == [6, 7, 8]


@pytest.mark.parametrize("how", [{}, {"hot": 3, "chunk": 4, "rarity_bits": 12}, {"hot": 1, "chunk": 16, "rarity_bits": 5}, {"sifting": True}])
def test_lines(spark, rows, docs, how):
    got = {(r["doc"], r["line"]): (r["match_doc"], r["match_line"]) if r["match_doc"] is not None else None for r in line_dedup.duplicate_lines(docs, **how).collect()}
    assert got == matches(rows)


def test_remove_lines(spark, rows, docs, nothing, sf):
    gone = {}
    for (i, n), m in matches(rows).items():
        if m:
            gone.setdefault(i, set()).add(n)
    want = {}
    for i, t in rows:
        if i in gone:
            left = [x for n, x in enumerate(t.split("\n")) if n not in gone[i]]
            if any(x.split() for x in left):
                want[i] = "\n".join(left)
        else:
            want[i] = t
    out = line_dedup.remove_lines(docs)
    assert out.columns == docs.columns and {r["doc_id"]: r["text"] for r in out.collect()} == want
    assert line_dedup.remove_lines(nothing).count() == 0
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup.op9_line_dedup(spark, sf(rows)).collect()}
    lines = Counter(i for i, _ in matches(rows))
    assert got == {i: (lines[i], len(gone.get(i, ()))) for i, _ in rows}


def test_rows_that_share_an_id_lose_nothing(spark):
    line = "keep this line please now"
    rows = [(1, f"one two three four five six\n{line}"), (1, "one two three four five six\nother words of a second text\nand more of them here"), (2, f"seven eight nine\n{line} again"), (2, "ten eleven twelve"), (2, "ten eleven twelve"), (None, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = sorted(((r["doc_id"] or 0, r["text"]) for r in line_dedup.remove_lines(docs).collect()), key=str)
    ver = {t: h for t, h in docs.select("text", line_dedup.text_hash("text")).collect()}
    first, second = sorted(rows[:2], key=lambda r: ver[r[1]])
    want = [first, (1, "\n".join(second[1].split("\n")[1:])), (2, "seven eight nine"), (2, "ten eleven twelve"), (2, "ten eleven twelve"), (0, line)]
    assert out == sorted(want, key=str)


def test_all_columns_of_the_lines_query(spark, sf):
    """Every column against all pairs of lines, with repeated ids, empty and very long texts."""
    r = np.random.default_rng(2)
    words = [f"w{k}" for k in range(60)]
    lines = [" ".join(r.choice(words, r.integers(1, 12))) for _ in range(60)]
    lines += [x + f" extra{k}" for k, x in enumerate(lines[:30])] + [" ".join(f"long{k}" for k in range(20_000)), " ".join(f"long{k}" for k in range(100, 20_100)), ""]
    rows = [(int(i), "\n".join(r.choice(lines, r.integers(0, 9)))) for i in r.integers(0, 50, 70)] + [(60, lines[-3]), (61, lines[-2]), (62, None), (63, "one\n" * 700), (None, "one")]
    ver = dict(spark.createDataFrame(rows, "doc_id long, text string").select("text", line_dedup.text_hash("text")).distinct().collect())
    keyed = {(i, ver[t]): t for i, t in rows if i is not None}
    every = sorted((i, v, n, frozenset(x.split())) for (i, v), t in keyed.items() for n, x in enumerate((t or "").split("\n")) if x.split())
    sets = sorted({s for *_, s in every}, key=sorted)
    like = {(a, b) for a in sets for b in sets if 4 * max(len(a), len(b)) <= 5 * min(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b)}
    n_lines, removed, links, label = Counter(), {}, Counter(), {i: i for i, _ in rows if i is not None}
    pairs = [(x[:2], y[:2]) for k, x in enumerate(every) for y in every[:k] if x[:2] != y[:2] and (x[3], y[3]) in like]
    for x, y in pairs:
        links[x] += 1
        links[y] += 1
    for _ in label:
        for (i, _), (j, _) in pairs:
            label[i] = label[j] = min(label[i], label[j])
    for k, (i, v, n, s) in enumerate(every):
        n_lines[i, v] += 1
        if any((s, t) in like for *_, t in every[:k]):
            removed.setdefault((i, v), []).append(n)
    want = [(i, n_lines[k], len(removed.get(k, ())), links[k], label[i], ",".join(map(str, removed.get(k, ())))) for i, t in rows if i is not None for k in [(i, ver[t])]] + [(None, 0, 0, 0, None, "")]
    got = line_dedup.op9_line_dedup(spark, sf(rows)).select("doc_id", "n_lines", "n_removed", "n_links", "class_id", "removed").collect()
    assert Counter(map(tuple, got)) == Counter(want)


def test_all_links_and_classes(spark, rows, sf):
    """n_links against all pairs of lines, class_id against their closure; a chain of documents and a group of similar lines among them."""
    base = [f"g{k}" for k in range(40)]
    rows = [*rows, (900, "p q r s t u"), (901, "p q r s t u\nv w x y z"), (902, "v w x y z"), *((910 + k, " ".join([*base[:k], f"h{k}", *base[k + 1 :]])) for k in range(40))]
    lines = [(i, frozenset(x.split())) for i, t in rows if i is not None for x in lower(t).split("\n") if x.split()]
    links, label = Counter(), {i: i for i, _ in rows}
    pairs = [(i, j) for k, (i, s) in enumerate(lines) for j, o in lines[:k] if i != j and 5 * len(s & o) >= 4 * len(s | o)]
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            least = min(label[i], label[j])
            changed |= label[i] != label[j]
            label[i] = label[j] = least
    got = {r["doc_id"]: (r["n_links"], r["class_id"]) for r in line_dedup.op9_line_dedup(spark, sf(rows)).collect()}
    assert label[902] == 900 and links[900] == 1 and links[949] == 39
    assert got == {i: (links[i], label[i]) for i, _ in rows}


def test_shares_of_hot_words_do_not_grow_with_parts(spark):
    """A word of 40 lines, of which 16 make it hot, is dealt into three shares at most, however many parts there are."""
    rows = line_dedup.numbered(spark.createDataFrame([(i, f"same a{i} b{i} c{i} d{i}") for i in range(40)], "doc_id long, text string"))
    counts = np.full(1 << 22, 40, np.uint16)
    out = line_dedup.prefixes(rows, spark.sparkContext.broadcast(counts), line_dedup.Fraction(1, 2), 1_000, hot=16).collect()
    word = line_dedup.line_sets([b"same"]).words[0]
    parts = {r["part"] for r in out if (np.frombuffer(r["data"], line_dedup._PREFIX)["word"] == word).any()}
    assert {r["kind"] for r in out} == {1} and 1 <= len(parts) <= 3


def test_candidates_in_a_crowd():
    """Of sets that share a rare word no pairs are candidates but those that share one more behind it; all similar ones are among them."""
    rng, t = np.random.default_rng(3), line_dedup.THRESHOLD
    texts = [b" ".join(b"w%d" % w for w in sorted({0, *rng.integers(1, 400, n).tolist()})) for n in rng.integers(3, 40, 150)]
    texts += [b" ".join(x.split()[:-1] + [b"odd%d" % i]) for i, x in enumerate(texts[:60])]
    x = line_dedup.line_sets(texts)
    words, often = x.by_rarity(np.full(1 << 22, 9, np.uint16))
    r, at = line_dedup._prefixes(words, often, x, x.ids(), np.ones(len(x.size), bool), t)
    order = np.lexsort((r["size"], r["word"]))
    r, line = r[order], x.line[at][order]
    key = np.ascontiguousarray(r["word"])
    sets = [set(y.split()) for y in texts]
    similar = {(a, b) for a in range(len(sets)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    for crowd in (None, 2, 8):
        pairs = [(max(line[a], line[b]), min(line[a], line[b])) for p in line_dedup.candidate_pairs(key, r, t, None, crowd) for a, b in zip(*p)]
        assert len(similar) >= 30 and similar <= set(pairs) | {(a, b) for a, b in similar if sets[a] == sets[b]}
    alone = np.zeros(50, line_dedup._PREFIX)
    alone["size"], alone["next"][:, 0] = 10, np.arange(1, 51)
    assert sum(len(a) for a, _ in line_dedup.candidate_pairs(np.zeros(50, np.int64), alone, t)) == 1225
    assert not list(line_dedup.candidate_pairs(np.zeros(50, np.int64), alone, t, None, 8))


def test_places_that_recur(spark):
    r = np.random.default_rng(4)
    parts = [r.integers(0, 1 << 22, n) for n in (0, 1, 5000, 60_000)] + [np.array([7, 7, 1 << 21]), np.array([0, (1 << 22) - 1]), np.array([(1 << 22) - 1])]
    seen = [line_dedup.seen_places(x) for x in parts]
    rows = spark.createDataFrame([x for s in seen for x in zip(s["piece"], s["data"])], line_dedup.RECURRING)
    bitmap = line_dedup.recurring_places(rows, 22)
    want = np.bincount(np.concatenate(parts), minlength=1 << 22) > 1
    assert (np.unpackbits(bitmap, bitorder="little").astype(bool) == want).all()
    assert (line_dedup.recurs(bitmap, np.arange(1 << 22, dtype=np.uint64) << np.uint64(42)) == want).all()


def test_places_that_recur_among_many_that_do_not(spark):
    """Finer places: a table of 2**22 that 3 000 000 different ones went into holds those that recur and hardly any other."""
    r = np.random.default_rng(5)
    every = np.unique(r.integers(0, 1 << 31, 3_000_000))
    twice = r.choice(every, 2_000, replace=False)
    parts = [*np.array_split(r.permutation(every), 5), twice[:1500], np.repeat(twice[1500:], 2), every[:0]]
    seen = [line_dedup.seen_places(x, 9) for x in parts]
    rows = spark.createDataFrame([x for s in seen for x in zip(s["piece"], s["data"])], line_dedup.RECURRING)
    got = np.flatnonzero(np.unpackbits(line_dedup.recurring_places(rows, 22, 9), bitorder="little"))
    assert got.tolist() == np.unique(twice >> 9).tolist()


def test_sums_of_counts(spark):
    r = np.random.default_rng(6)
    tables = []
    for n, most in ((10, 3), (200_000, 5), (1_000_000, 2)):
        x = np.zeros(1 << 18, np.int64)
        np.add.at(x, r.integers(0, 1 << 18, n), r.integers(1, most, n))
        tables.append(x)
    tables.append(tables[-1] * 300)
    rows = spark.createDataFrame([x for t in tables for x in line_dedup.packed_counts(t)], "piece bigint, data binary")
    assert (line_dedup.summed_counts(rows, 18) == np.minimum(np.minimum(tables, 65_535).sum(0), 65_535)).all()


def test_fingerprints_of_ids_that_are_words(spark, rows):
    docs = spark.createDataFrame([(None if i is None else f"id{i:04d}", t) for i, t in rows], "doc_id string, text string").repartition(4)
    schema = "doc_id string, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.with_next(docs, fingerprints.with_edits, schema).collect()}
    ordered = sorted((("" if i is None else f"id{i:04d}", t or "") for i, t in rows))
    text = [t for _, t in ordered]
    for k, (i, t) in enumerate(ordered):
        n = len(t) // 4
        assert got[i or None] == hashlib.sha256((t[: len(t) - n] + text[(k + 1) % len(text)][:n]).encode()).hexdigest()


@pytest.mark.parametrize("how", [{}, {"limit": 30}, {"limit": 2, "passes": 3, "block_tokens": 700}, {"limit": 10**9, "passes": 2, "block_tokens": 700}])
def test_lm_scores_of_buckets_are_those_of_the_whole_tree(spark, rows, docs, how):
    """Hot words, pairs and triples, and contexts that are kept only as their suffixes, change no score."""
    cut = lm_scoring.materialise(lm_scoring.blocks(docs), "blocks")
    counts = lm_scoring.word_counts(cut)
    n, v = (int(x) for x in counts.selectExpr("sum(n)", "count(*)").first())
    totals = lm_scoring.Totals(n, v, lm_scoring.DISCOUNT)
    tree, known = lm_scoring.grow(cut, counts, totals), {x["word"]: x["n"] for x in counts.collect()}
    want = []
    for b in cut.collect():
        tokens, _, starts = lm_scoring._tokens(bytes(b["tokens"]), b["words"], b["sizes"])
        each = lm_scoring.token_scores(tree, totals, tokens, starts, np.array([known.get(x, 0) for x in tokens.tolist()]))
        want += zip(b["ids"], np.add.reduceat(each, starts).tolist())
    got = [(x["doc_id"], x["score"]) for x in lm_scoring.score(docs, **how).collect()]
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [i for i, _ in got] == [i for i, _ in want] and [s for _, s in got] == pytest.approx([s for _, s in want])
