"""Hard negatives, ranked search and line dedup against brute force, and their results for odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskengine.llm import hardneg, lexical, linededup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- operator 11


def mined(spark, rows, every=5, **options):
    frame = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>, score string, rank int")
    found = hardneg.hard_negatives(frame, hardneg.F.col("vec_id") % every == 0, **options)
    return sorted(tuple(r) for r in found.collect())


def mined_brute(rows, every=5, positives=5, negatives=3, low=50, high=95):
    usable = {}
    for i, label, vector, *_ in rows:
        if i is None or label is None or vector is None or not all(x is not None and math.isfinite(x) for x in vector):
            continue
        key = (label, vector)
        usable[i] = min(usable.get(i, key), key)
    whole = {i: (label, [max(-(2**53), min(2**53, math.floor(256 * x))) for x in v]) for i, (label, v) in usable.items()}
    out = []
    for a, (label, q) in whole.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, other)), i) for i, (_, other) in whole.items() if i != a)
        near = [(p, -s) for s, p in scored if whole[p][0] == label][:positives]
        for p, score in near:
            hard = [(i, -s) for s, i in scored if whole[i][0] != label and low * score <= -100 * s <= high * score]
            out += [(a, p, k + 1, i, score, s) for k, (i, s) in enumerate(hard[:negatives])]
    return sorted(out)


def vectors(seed, n, dims, labels=3, wide=1.0):
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(labels)), (rng.normal(size=dims) * wide).tolist(), "x", 1) for i in range(n)]


@pytest.mark.parametrize("dims", [1, 7, 8, 20])
def test_hard_negatives_equal_brute_force(spark, dims):
    rows = vectors(dims, 120, dims)
    assert mined(spark, rows) == mined_brute(rows) != []


def test_hard_negatives_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "CANDIDATE_ROWS", 16)
    monkeypatch.setattr(hardneg, "ANCHOR_ROWS", 4)
    rows = vectors(5, 150, 6)
    rows += [(1000 + i, 1, rows[0][2], "x", 1) for i in range(60)]  # a hot vector under one label
    assert mined(spark, rows) == mined_brute(rows)


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(3, 40, 4)
    rows += [(None, 1, [1.0], "x", 1), (50, None, [1.0], "x", 1), (55, 1, None, "x", 1), (60, 1, [nan, 1.0], "x", 1)]
    rows += [(65, 1, [inf], "x", 1), (70, 1, [None, 1.0], "x", 1), (75, 1, [], "x", 1), (80, 2, [0.3, 0.2], "x", 1)]
    rows += [rows[0], rows[1], (2, 0, [0.1, 0.1], "x", 1), (85, -1, [0.5] * 9, "x", 1)]
    assert mined(spark, rows) == mined_brute(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0], "x", 1)]) == []
    assert mined(spark, [(0, 1, [1.0], "x", 1)]) == []


def test_hard_negatives_of_very_large_components(spark):
    """Scores beyond 64 bits are ranked exactly and returned as the nearest long."""
    rows = vectors(9, 40, 3, wide=1e13)
    limit = 2**63 - 1
    cut = [(a, p, k, n, min(x, limit), min(y, limit)) for a, p, k, n, x, y in mined_brute(rows)]
    assert mined(spark, rows) == cut != []
    rows = vectors(9, 40, 3, wide=1e6)
    assert mined(spark, rows) == mined_brute(rows)


@pytest.mark.parametrize("limit", [255, 2**40])
def test_lookups_give_inner_products(limit):
    rng = np.random.default_rng(1)
    a, c = rng.integers(-limit - 1, limit + 1, (9, 13)), rng.integers(-limit - 1, limit + 1, (700, 13))
    kind = np.int32 if limit < 256 else object
    found = hardneg.scores(hardneg.bit_planes(c, limit.bit_length() + 1), hardneg.subset_sums(a.astype(kind), kind))
    assert (found == c.astype(object) @ a.astype(object).T).all()


# --- operator 12


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked_brute(docs, items, top=20):
    counts = [(i, Counter(terms(text))) for i, text, *_ in docs]
    held = [(i, c) for i, c in counts if c]
    n_docs, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for i, c in held:
            m = 100 - 25 + (25 * c.total() * n_docs) // length
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string, item_id int, rank int")
    items = spark.createDataFrame(items, "item_id int, text string")
    return sorted((tuple(r) for r in lexical.rank_documents(docs, items, **options).collect()), key=str)


def corpus(seed, n, vocabulary=60):
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(vocabulary)]
    skew = [1 / (k + 1) for k in range(vocabulary)]
    return [(i, " ".join(rng.choices(names, skew, k=rng.randint(0, 40))), 7, 7) for i in range(n)]


def test_ranking_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lexical, "FIRST_SLICE", 2)
    docs = corpus(1, 600)
    items = [(k, d[1]) for k, d in enumerate(corpus(2, 12))]
    assert ranked(spark, docs, items) == ranked_brute(docs, items)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 50)
    assert ranked(spark, docs, items, block_bytes=300) == ranked_brute(docs, items)


def test_ranking_resolves_ties_by_id(spark):
    docs = [(i, "alpha beta", 1, 1) for i in range(100, 0, -1)] + [(500, "gamma", 1, 1), (600, "delta alpha", 1, 1)]
    items = [(1, "alpha"), (2, "beta gamma"), (3, "absent"), (4, "")]
    assert ranked(spark, docs, items) == ranked_brute(docs, items)


def test_ranking_of_odd_rows(spark):
    docs = corpus(4, 60) + [(None, "w1 w2", 1, 1), (None, "w1 w2", 1, 1), (3, "w1 W1 w1", 1, 1), (61, None, 1, 1), (62, "", 1, 1)]
    docs += [(63, "\x00.,;", 1, 1), (64, "Éclair éclair ÉCLAIR w1-w2", 1, 1), (65, "w3 " * 50_000, 1, 1)]
    items = [(1, "w1 w2"), (1, "w1 w2"), (1, "w3"), (None, "éclair w3 w3"), (2, None), (3, "W1")]
    kept = [x for x in items if x[1] is not None]
    assert ranked(spark, docs, items) == ranked_brute(docs, kept)
    assert ranked(spark, [], items) == []
    assert ranked(spark, docs, []) == []
    assert ranked(spark, [(1, None, 1, 1)], items) == []


def test_words_of_a_long_text_are_cut_at_spaces(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE_BYTES", 5)
    text = "Alpha beta-GAMMA é1 " * 7 + "omega"
    assert [w.decode() for part in lexical.words(text.encode()) for w in part] == terms(text)


def test_nra_stops_before_the_end_of_the_lists():
    """Two lists: one document leads both, so the tails are not read."""
    reads = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                reads.append(key.stop)
            return super().__getitem__(key)

    n = 100_000
    docs, weights = np.arange(n), np.concatenate([[10**6], np.arange(n - 1, 0, -1)])
    lists = [(docs.view(Watched), weights), (docs.view(Watched), weights)]
    found, score = lexical.nra(lists, n, 1)
    assert found.tolist() == [0] and score.tolist() == [2 * 10**6]
    assert max(reads) <= 2 * lexical.FIRST_SLICE


@pytest.mark.parametrize("seed", range(20))
def test_nra_returns_all_ties_of_the_last_place(seed):
    rng = np.random.default_rng(seed)
    n, top = 300, int(rng.integers(1, 30))
    lists, total = [], np.zeros(n, np.int64)
    for _ in range(rng.integers(1, 9)):
        docs = rng.choice(n, rng.integers(0, n), replace=False)
        weights = rng.integers(1, rng.choice([4, 1000]), len(docs))
        total[docs] += weights
        order = np.lexsort((docs, -weights))
        lists.append((docs[order], weights[order]))
    found, score = lexical.nra(lists, n, top, first=int(rng.integers(1, 5)))
    assert (score == total[found]).all()
    last = np.sort(total)[::-1][top - 1]
    assert set(np.flatnonzero((total >= last) & (total > 0))) <= set(found.tolist())


def test_nra_leaves_out_what_cannot_reach_the_floor():
    docs = np.arange(10)
    found, _ = lexical.nra([(docs, np.arange(10, 0, -1))], 10, 3, floor=9)
    assert found.tolist() == [0, 1]


# --- operator 13


def key_of(line):
    return line.strip(" \t\n\v\f\r").translate(LOWER)


def deduped_brute(docs, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    for i, text, *_ in docs:
        for line in (text or "").split("\n"):
            if i is not None and len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(i)
    out = []
    for i, text, *_ in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[key_of(x)]) < min_docs or i == max(holders[key_of(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def deduped(spark, docs, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string, pos int, key_hash string, dropped int, lines string")
    columns = ["doc_id", "n_lines", "n_dropped", "text"]
    return sorted((tuple(r) for r in linededup.dedup_lines(frame, **options).select(columns).collect()), key=str)


def lined(i, *lines):
    return (i, "\n".join(lines), 1, "x", 2, "y")


COMMON = "This line stands in many documents"


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    pool = [f"shared line number {k} of the pool" for k in range(30)] + ["short", "", " \t "]
    docs = [lined(i, *(rng.choice(pool) + rng.choice(["", " ", "\r"]) for _ in range(rng.randint(1, 12)))) for i in range(80)]
    assert deduped(spark, docs) == deduped_brute(docs)
    assert deduped(spark, docs, min_chars=3, min_docs=10) == deduped_brute(docs, 3, 10)


def test_line_dedup_of_odd_rows(spark):
    docs = [lined(i, f"own line of document number {i}", f" {COMMON.upper()}\t", COMMON) for i in range(5)]
    docs += [docs[0], lined(1, COMMON, "another text under the same id"), (7, None, 1, "x", 2, "y"), lined(8, "")]
    docs += [lined(None, COMMON), lined(None, COMMON, "x"), lined(9, "", "", ""), lined(10, "é" * 19), lined(11, "é" * 19)]
    docs += [lined(12, "é" * 19), lined(13, *["É" * 20] * 3), lined(14, "É" * 20), lined(15, "É" * 20), lined(16, "é" * 20)]
    docs += [lined(17, COMMON + " "), lined(20, *[COMMON, "tail\r"] * 20_000)]
    assert deduped(spark, docs) == deduped_brute(docs)
    assert deduped(spark, []) == []


def test_lines_of_two_documents_stay(spark):
    docs = [lined(1, COMMON, COMMON, COMMON), lined(2, COMMON)]
    assert [r[2] for r in deduped(spark, docs)] == [0, 0]
    assert hashlib.md5(key_of(COMMON).encode()).digest() in {
        bytes(r["key_hash"])
        for r in linededup.hashed_lines(spark.createDataFrame([(1, COMMON)], "doc_id long, text string")).collect()
    }
