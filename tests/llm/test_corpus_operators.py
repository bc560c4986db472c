"""Corpus operators against brute force, and their defined results for odd rows."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskengine.llm import (
    chat,
    decontaminate,
    hyperminhash,
    licenses,
    mixing,
    neardup,
    outliers,
    pii,
    quality,
    urls,
    warc,
)
from riskengine.llm.components import components
from riskengine.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, slot string, block string, words string, bucket string"
WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) for _ in range(n))


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None, "x", None, "y", "z")


@pytest.fixture(scope="module")
def odd_docs(spark):
    rng = random.Random(1)
    base = prose(rng, 120)
    rows = [doc(0, base), doc(1, base), doc(1, base), doc(2, base.replace("w7 ", "w8 ", 1)), doc(3, None), doc(4, "")]
    rows += [doc(5, " \n\t "), doc(None, base), doc(6, "one two"), doc(7, "ONE  two"), doc(8, prose(rng, 20_000), None, None)]
    rows += [doc(9 + i, prose(rng, 60), source=None if i % 3 else "hot") for i in range(20)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def shingle_set(text, n):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def brute_components(texts, n=4):
    sets = {i: shingle_set(t, n) for i, t in texts.items()}
    label = {i: i for i in texts}
    changed = True
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    texts, i = {}, 0
    passage = prose(rng, 60)
    for _ in range(25):
        words = prose(rng, rng.choice([5, 30, 150, 400])).split()
        for _ in range(rng.choice([1, 1, 4, 12])):
            copy = [rng.choice(WORDS) if rng.random() < 0.02 else w for w in words]
            texts[i] = " ".join(copy) + (" " + passage if rng.random() < 0.3 else "")
            i += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in neardup.near_duplicates(df, 4).collect()}
    want = brute_components(texts)
    assert {k: r["component_id"] for k, r in got.items()} == want
    assert all(r["n_shingles"] == len(shingle_set(texts[k], 4)) and r["kept"] == (want[k] == k) for k, r in got.items())
    kept = neardup.keep_one_of_each(df, 4)
    assert {r["doc_id"] for r in kept.collect()} == set(want.values())


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    got = defaultdict(list)
    for r in neardup.near_duplicates(odd_docs).collect():
        got[r["doc_id"]].append((r["n_shingles"], r["component_id"], r["kept"]))
    assert got[3] == [(0, 3, True)] and got[4] == [(0, 4, True)] and got[5] == [(0, 5, True)]
    assert got[1] == [(116, 0, False)] * 2 and got[2][0][1] == 0
    assert got[None] == [(116, None, True)]
    assert got[7] == [(1, 6, False)] and got[8][0][2]
    kept = neardup.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 4
    assert neardup.near_duplicates(no_docs).count() == 0 and neardup.keep_one_of_each(no_docs).count() == 0


def test_sketch_estimates_and_parities():
    rng = np.random.default_rng(5)
    errors = []
    for n in (3, 40, 900):
        for _ in range(30):
            u = np.unique(rng.integers(1, 2**63, 2 * n).astype(np.uint64))
            a, b = np.sort(u[: n + n // 2]), np.sort(u[n // 2 :])
            x, y = hyperminhash.sketch(a), hyperminhash.sketch(b)
            true = len(np.intersect1d(a, b)) / len(u)
            est = hyperminhash.estimated_jaccard(x[None], y[None], np.array([len(a)]), np.array([len(b)]))[0]
            errors.append(est - true)
            p, q = hyperminhash.parity_words(a), hyperminhash.parity_words(b)
            assert sum(int(v).bit_count() for v in (p ^ q).view(np.uint64)) <= len(np.setxor1d(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(900 + i, 901 + i) for i in range(40)]
    label = {v: v for e in links for v in e}
    for _ in range(60):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {k: v for k, v in label.items() if k != v}


def brute_windows(text, items, n=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    words, hit, found = split(text), set(), set()
    for item, body in items:
        w = split(body)
        for win in [w[i : i + n] for i in range(max(1, len(w) - n + 1))] if w else []:
            for i in range(len(words) - len(win) + 1):
                if words[i : i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_decontamination_equals_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.choice([3, 10, 30]))) for i in range(12)] + [(50, None), (51, ""), (3, "again w1 w2")]
    texts = {}
    for i in range(60):
        body = prose(rng, 50).split()
        if i % 3 == 0:
            part = (rng.choice(items[:12])[1]).split()
            body[20:20] = part[rng.randrange(3) :] if len(part) > 12 else part
        texts[i] = ", ".join(w.upper() if rng.random() < 0.3 else w for w in body)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.decontaminate(docs, bench).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}
    want = {i: brute_windows(t, items) for i, t in texts.items()}
    assert got == want and any(v[4] for v in want.values()) and not all(v[4] for v in want.values())
    clean = decontaminate.drop_contaminated(docs, bench)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, v in want.items() if not v[4]}
    assert decontaminate.decontaminate(odd_docs, bench).count() == odd_docs.count()
    assert decontaminate.drop_contaminated(odd_docs, bench).columns == odd_docs.columns
    assert decontaminate.decontaminate(no_docs, bench).count() == 0
    assert decontaminate.decontaminate(odd_docs, bench.limit(0)).where("contaminated").count() == 0


def test_text_statistics_equal_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(6)
    texts = {0: None, 1: "", 2: "a b c d e f a b c d e f a b c d e", 3: "x\n x\nx\n\nx", 4: "# $ a|b <c> 100%", 5: "é É a a a a a a a a a a a"}
    texts |= {10 + i: prose(rng, 40, WORDS[:6]) + "\n" + prose(rng, 12, WORDS[:3]) for i in range(30)}
    rows = outliers.with_statistics(
        spark.createDataFrame([(i, t, "en", "s") for i, t in texts.items()], "doc_id long, text string, lang string, source string")
    ).collect()
    for r in rows:
        t = texts[r["doc_id"]] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen, covered = defaultdict(list), set()
        for i in range(len(words) - 4):
            seen[tuple(words[i : i + 5])].append(i)
        for at in seen.values():
            if len(at) > 1:
                covered |= {p for i in at for p in range(i, i + 5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
    judged = outliers.reject_outliers(odd_docs)
    assert judged.count() == odd_docs.count() and judged.where("kept is null or (base_failed and kept)").count() == 0
    assert outliers.reject_outliers(no_docs).count() == 0


def brute_mcd(x, starts=(0, 1, 2, 3)):
    """Centre, covariance and log-determinant of the least determinant over the given starts."""
    granted = np.array(list(outliers.STATISTICS.values()))

    def quantile(bins, share):
        values, counts = np.unique(bins, return_counts=True)
        return values[np.argmax(counts.cumsum() >= share * counts.sum())]

    centre = np.array([quantile(np.ceil(c * outliers.VALUE_BINS), 0.5) / outliers.VALUE_BINS for c in x.T])
    z = (x - centre) / granted
    signs = z / np.maximum(np.sqrt((z**2).sum(axis=1)), 1e-9)[:, None]
    scaled = lambda u: (u.T @ u) / len(u) * np.outer(granted, granted)
    shapes = [np.zeros((5, 5)), scaled(signs), scaled(np.tanh(z)), np.cov(x.T, bias=True).reshape(5, 5)]
    state = {k: [np.inf, x.mean(axis=0) if k == 3 else centre, shapes[k] + np.diag(granted**2), True] for k in starts}
    for step in range(1, outliers.MAX_STEPS + 1):
        for held in state.values():
            if held[3]:
                d = np.einsum("ij,jk,ik->i", x - held[1], np.linalg.inv(held[2]), x - held[1])
                bins = np.ceil(np.log1p(d) * outliers.DISTANCE_BINS)
                near = x[bins <= quantile(bins, outliers.SUBSET)]
                cov = np.cov(near.T, bias=True).reshape(5, 5) * outliers.CONSISTENCY + np.diag(granted**2)
                logdet = np.linalg.slogdet(cov)[1]
                held[3] = held[0] - logdet > outliers.TOLERANCE
                if logdet < held[0]:
                    held[:3] = logdet, near.mean(axis=0), cov
        if step == outliers.TRIAL_STEPS:
            state = dict(sorted(state.items(), key=lambda s: (s[1][0], s[0]))[: outliers.KEPT])
    logdet, centre, cov, _ = min(state.values(), key=lambda h: h[0])
    return centre, cov, logdet


def drawn_distances(x, *chain):
    """Distances of x by the estimate of the last sample of the chain, drawn towards those before."""
    centre, cov = brute_mcd(chain[0])[:2]
    for sample in chain[1:]:
        share = len(sample) / (len(sample) + outliers.SHRINK)
        own = brute_mcd(sample)[:2]
        centre, cov = share * own[0] + (1 - share) * centre, share * own[1] + (1 - share) * cov
    return np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)


STATS_SCHEMA = "doc_id long, lang string, source string, " + ", ".join(f"{n} double" for n in outliers.STATISTICS)


def test_outliers_equal_numpy(spark):
    rng = np.random.default_rng(11)
    groups = [("en", "a", 120), ("en", "b", 20), ("en", None, 7), ("en", "", 3), ("de", "b", 9), (None, "c", 3)]
    rows = [(*g[:2], *map(float, rng.normal(size=5) * 0.05 + (1.5 if i % 10 == 5 else 0.3))) for g in groups for i in range(g[2])]
    rows = [(i, *r) for i, r in enumerate(rows)]
    # A group and a language of which no text passes: measured as what they are drawn towards.
    failing = [(900, "en", "z", *[0.3] * 5), (901, "fr", "z", *[0.3] * 5)]
    passing = spark.createDataFrame(rows, STATS_SCHEMA)
    got = {r["doc_id"]: r for r in outliers.measured_rows(spark.createDataFrame(rows + failing, STATS_SCHEMA), passing).collect()}
    assert {i: (r["lang"], r["source"]) for i, r in got.items()} == {r[0]: r[1:3] for r in rows + failing}
    vectors = lambda part: np.array([r[3:] for r in part])
    for lang, source in {r[1:3] for r in rows + failing}:
        mine = [r for r in rows + failing if r[1:3] == (lang, source)]
        samples = [rows, [r for r in rows if r[1] == lang], [r for r in rows if r[1:3] == (lang, source)]]
        want = drawn_distances(vectors(mine), *(vectors(s) for s in samples if s))
        assert np.allclose([got[r[0]]["distance"] for r in mine], want, rtol=1e-6)
    assert all((got[r[0]]["distance"] > outliers.CUTOFF) == (r[3] > 0.9) for r in rows)
    assert 1e-11 < outliers.chi2_tail(outliers.CUTOFF) < 1e-10 and abs(outliers.chi2_tail(6.6257) - 0.25) < 1e-4
    texts = spark.createDataFrame([doc(i, prose(rng_words, 40)) for rng_words in [random.Random(1)] for i in range(12)] + [doc(90, "one two")], DOCS)
    assert outliers.reject_outliers(texts).where("distance is null").count() == 0
    assert outliers.reject_outliers(texts.where("doc_id = 90")).where("not kept and distance is null").count() == 1


def test_outliers_take_the_start_of_least_determinant(spark):
    # Two clouds of which neither holds 75 %: where a start ends depends on where it begins.
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(70, 5)) * [0.3, 0.02, 0.02, 0.02, 0.3] + 0.5, rng.normal(size=(60, 5)) * 0.02 + [0.9, 0.1, 0.9, 0.1, 0.9]])
    df = spark.createDataFrame([(i, "en", "a", *map(float, v)) for i, v in enumerate(x)], STATS_SCHEMA)
    found = outliers.estimates_of(outliers._with_pools(df)).where("pool like 'group %'").first()
    each = [brute_mcd(x, (k,))[2] for k in range(4)]
    assert found["logdet"] == pytest.approx(min(each), abs=1e-6) and found["n"] == 130
    assert max(each) - min(each) > 0.01


def test_a_tiny_source_ends_its_own_part_of_the_mix_alone(spark):
    rows = [(i, "ab"[i % 3 == 0]) for i in range(4000)] + [(4000, "tiny"), (4001, "small"), (4002, "small")]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    parts = spark.createDataFrame([("a", 12, 20), ("b", 6, 20), ("small", 1, 20), ("tiny", 1, 20)], "source string, parts long, period long")
    out = mixing.pfair_mix(docs, parts, block_docs=2).collect()
    assert len({r["doc_id"] for r in out}) == len(rows)
    by_phase = Counter(r["phase"] for r in out)
    assert by_phase[2] > 3000 and all(r["in_mix"] == (r["phase"] == 0) for r in out)
    assert all(r["in_mix"] for r in out if r["source"] in ("tiny", "small"))
    later = Counter(r["source"] for r in out if r["phase"] == 2)
    assert abs(later["a"] - 2 * later["b"]) <= 6


def test_mixing_keeps_every_source_within_a_block(spark, odd_docs, no_docs):
    sizes = {"a": 900, "b": 300, "c": 70, None: 40}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    parts = [("a", 47, 100), ("b", 31, 100), ("c", 15, 100), (None, 7, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    mixed = mixing.pfair_mix(docs, spark.createDataFrame(parts, "source string, parts long, period long"), block_docs=1)
    out = sorted(mixed.collect(), key=lambda r: r["slot"])
    assert sorted(r["doc_id"] for r in out) == list(range(len(rows)))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in out)
    prefix = [r for r in out if r["in_mix"]]
    assert [r["slot"] for r in prefix] == list(range(len(prefix))) and len(prefix) >= 400
    weight, taken = {p[0]: p[1] / p[2] for p in parts}, defaultdict(int)
    for t, r in enumerate(prefix, 1):
        taken[r["source"]] += 1
        assert all(abs(taken[s] - w * t) < 1 for s, w in weight.items())
    assert {r["phase"] for r in out} == set(range(len(sizes)))
    slots, last = defaultdict(list), {}
    for r in out:
        slots[r["source"]].append(r["slot"])
    for s, taken_at in slots.items():
        assert all(abs(n - weight[s] * (t + 1)) < 1 for n, t in enumerate(taken_at, 1))
        last[s] = taken_at[-1]
    # A source still counts as there in the slots between its last block and the one that finds it empty.
    assert all(r["phase"] <= sum(t < r["slot"] for t in last.values()) for r in out)
    assert mixing.pfair_mix(odd_docs).count() == odd_docs.count() and mixing.pfair_mix(no_docs).count() == 0
    whole = mixing.temperature_parts(docs.groupBy("source").agg(F.count("*").alias("n"))).collect()
    assert sum(r["parts"] for r in whole) == whole[0]["period"] and min(r["parts"] for r in whole) > 0


def test_licenses(spark, odd_docs, no_docs):
    texts = {
        0: "x mit License mit license",
        1: "Foo.\nLicensed under CC BY-NC 4.0.\nbar",
        2: "the GNU General-Public (License)",
        3: None,
        4: "released under the license mit",
        5: "permission hereby granted free of charge to any person obtaining a copy of this software and documentation",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(df).collect()}
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["last_word"], got[0]["base_labels"]) == (2, 1, 3, "mit")
    assert got[1]["labels"] == "cc-by,cc-by-nc-notice" and got[1]["score"] == 1.0 and got[1]["first_word"] == 3
    assert got[2]["base_labels"] == "gpl" and (got[3]["n_words"], got[3]["labels"], got[3]["first_word"]) == (0, "", None)
    assert got[4]["base_labels"] == "" and got[4]["labels"] == "mit-notice"
    assert "mit-permission" in got[5]["labels"] and 0.8 <= got[5]["score"] < 1
    assert {r["score"] for r in licenses.scan_licenses(df, {}).collect()} == {0.0}
    assert licenses.scan_licenses(odd_docs).count() == odd_docs.count() and licenses.scan_licenses(no_docs).count() == 0


def test_urls(spark):
    given = [
        (0, "http://A.Example.NET/en/1", "example.net/en/", "allow"),
        (1, "https://example.net", None, "allow"),
        (2, "https://x.net/?q", "net/", "block"),
        (3, "ftp://b.example.com/de/x?y#z", "example.com/de/", "block"),
        (4, "http://w.org/fr/", "org/fr/", "allow"),
        (5, None, None, "allow"),
        (6, "no scheme", None, "allow"),
        (7, "http://www.bad.example.com/a/?utm_source=x&b=2&a=1#top", None, "block"),
        (8, "http://bad.example.com/a2", None, "allow"),
        (8, "http://bad.example.com/a2", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u, _, _ in given], "page_id long, url string, html string, verdict string")
    listed = spark.createDataFrame([("https://bad.example.com/a?a=1&b=2",), (None,), ("",), ("x",)], "url string")
    rows = urls.judge_urls(pages, listed).collect()
    assert sorted((r["page_id"], r["rule"] or "", r["verdict"]) for r in rows) == sorted((i, r or "", v) for i, _, r, v in given)
    assert all(r["bloom_hit"] for r in rows if r["listed"])
    assert urls.judge_urls(pages, listed.limit(0)).where("listed or bloom_hit").count() == 0
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("url"))
    many = spark.range(6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/k"), "id").alias("url"))
    found = urls.judge_urls(many, keys.select(F.concat(F.lit("http://h/"), "url").alias("url")))
    assert found.where("listed").count() == 3000 and found.where("bloom_hit and not listed").count() < 100
    assert urls.judge_urls(pages.limit(0), listed).count() == 0


def test_warc_round_trip(spark):
    magic = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    body = "é" * 60
    html = {0: body, 1: body, 2: None, 3: "", 4: magic * 3, 5: "short", 6: "short", 7: magic, 8: "tail\r\n\r\n", 9: body}
    pages = spark.createDataFrame(
        [(i, None if i == 3 else f"http://h/{i}\nx", t, "clash") for i, t in html.items()], "page_id long, url string, html string, digest string"
    ).coalesce(1)
    got = {r["page_id"]: r for r in warc.archive_and_read(pages).collect()}
    assert sorted(got) == list(range(10))
    for i, t in html.items():
        data = (t or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
    assert {i: r["refers_to"] for i, r in got.items() if r["record_type"] == "revisit"} == {1: 0, 9: 0}
    path = scratch_path(spark, "warc-test")
    warc.write_warc(pages, path)
    found = warc.candidates(spark, path)
    reached = warc.reachable(found)
    assert found.count() == 14 and reached.count() == 10
    records = warc.read_warc(spark, path, with_payload=True).collect()
    assert all(r["intact"] for r in records) and {bytes(r["payload"]) for r in records} >= {magic.encode(), b"short"}
    assert warc.archive_and_read(pages.limit(0)).count() == 0
    # Large pages make files of few records.
    assert warc.records_per_file(pages) == warc.RECORDS_PER_FILE and warc.records_per_file(pages.limit(0)) == warc.RECORDS_PER_FILE
    assert warc.records_per_file(pages.select(F.repeat(F.lit("x"), 1 << 20).alias("html"))) == 64
    odd = spark.createDataFrame([(None, None, "z" * 200), (7, None, "z" * 200), (7, "http://h/7", "z" * 200)], "page_id long, url string, html string")
    assert sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in warc.archive_and_read(odd).collect()) == [
        (-1, "revisit", 7), (7, "response", None), (7, "response", None)
    ]


def test_chat_round_trip(spark):
    rng = random.Random(8)
    pieces = ["<|im_start|>", "<|im_end|>", "\n", "<", "|", "\\", "<\\|", "assistant", "%0A", "é", ""]
    for _ in range(3000):
        role, text = ("".join(rng.choice(pieces) for _ in range(rng.randrange(6))) for _ in range(2))
        assert [t[:2] for t in chat.parse(chat.render(role, text))] == [(role, text)]
    assert chat.render("user", "plain < text") == "<|im_start|>user\nplain < text<|im_end|>\n"
    rows = [(1, 1, "assistant", "b<|im_end|>", "x"), (1, 0, "user", "a", "x"), (None, None, None, None, "x"), (2, 0, "assistant", None, "x"), (2, 0, "assistant", "t", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == digest("user\na\nassistant\nb<|im_end|>\n") and got[1]["loss_chars"] == 11
    assert got[1]["loss_sha256"] == digest("b<|im_end|>") and got[2]["loss_sha256"] == digest("t") and got[2]["n_turns"] == 2
    assert got[None]["turns_sha256"] == digest("\n\n") and got[None]["loss_chars"] == 0
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


def test_pii(spark, odd_docs, no_docs):
    texts = [
        "mail a.b@c.example.com, now", "at 10.20.30.40 or 300.1.1.1", "pay 4111 1111 1111 1111 today", "call +1 (942) 555-3625 ok",
        "é 4111111111111112 no", None, "+12 3", "nothing",
    ]
    rows = [(i, t) for i, t in enumerate(texts * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find_pii(df).collect()}
    assert len(got) == len(rows)
    assert got[0]["base_list"] == "email:5:22" and got[1]["base_list"] == "ip:3:14"
    assert got[2]["base_list"] == "card:4:23" and got[3]["base_list"] == "phone:5:22"
    assert all(got[i]["base_list"] == "" for i in (4, 5, 6, 7))
    assert all(set(filter(None, r["base_list"].split(","))) <= set(r["spans"].split(",")) for r in got.values())
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert clean[0] == "mail [EMAIL], now" and clean[2] == "pay [CARD] today" and clean[3] == "call [PHONE] ok"
    assert clean[5] is None and clean[7] == "nothing"
    assert pii.redact(odd_docs).columns == odd_docs.columns and pii.redact(odd_docs).count() == odd_docs.count()
    assert pii.find_pii(no_docs).count() == 0


def test_pii_base_rule_equals_the_plain_patterns_and_stays_linear():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(12)
    for _ in range(20_000):
        text = "".join(rng.choice("a1_.@@-+ é.") for _ in range(rng.randrange(24)))
        assert list(pii.emails(text)) == [m.span() for m in email.finditer(text)]
        text = "".join(rng.choice("129.. é") for _ in range(rng.randrange(24)))
        assert [m.span() for m in pii.BASE["ip"].finditer(text)] == [m.span() for m in ip.finditer(text)]
    blob = "a" * 500_000 + " " + "7" * 500_000
    start = time.perf_counter()
    assert pii.base_spans(blob + " x@y.z " + "7" * 500_000) == [("email", 1_000_002, 1_000_007)]
    assert time.perf_counter() - start < 20


def test_quality_held_out_accuracy(spark, odd_docs, no_docs):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        good = i % 4 != 0
        text = prose(rng, 80) if good else " ".join(w + rng.choice(["!!", "###"]) for w in prose(rng, 80).split())
        rows.append((i, text))
        labels.append((i, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(5, None), (99999, 1)], "doc_id long, quality int")
    held = [r for r in quality.classify(df, lab).collect() if r["held_out"]]
    right = sum(r["predicted"] == (r["doc_id"] % 4 != 0) for r in held)
    assert len(held) > 150 and right >= 0.97 * len(held) and all(0 <= r["score"] <= 1 for r in held)
    none = quality.classify(odd_docs, lab.limit(0)).collect()
    assert len(none) == odd_docs.count() and {r["score"] for r in none} == {0.5}
    assert quality.classify(no_docs, lab).count() == 0
    assert quality.keep_good(odd_docs, lab).columns == odd_docs.columns


def test_dual_descent_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 50, 20)) if i % 2 else np.unique(rng.integers(30, 80, 20)) for i in range(200)]
    good = np.arange(200) % 2 == 1
    ratio = quality.log_count_ratio(rows, good)
    weights, bias = quality.dual_coordinate_descent(rows, ratio, good)
    margin = [weights[r] @ ratio[r] / np.linalg.norm(ratio[r]) + bias for r in rows]
    assert ((np.array(margin) > 0) == good).mean() > 0.97


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(corpus_pipeline.COLUMNS)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "minhash near-dedup", "benchmark decontamination", "pii", "mixing"]
    ids = {r["doc_id"] for r in docs.collect()}
    out = corpus_pipeline.run(spark, folder).collect()
    assert out and {r["doc_id"] for r in out} < ids and len({r["doc_id"] for r in out}) == len(out)
    assert not any(pii.base_spans(r["text"]) for r in out)


def test_pii_adds_disguised_forms_and_no_clean_numbers(spark):
    rng = random.Random(21)

    def number(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card(sep):
        d = "4" + number(14)
        d += next(c for c in "0123456789" if pii.luhn(d + c))
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    def bad_card(sep):
        d = card("")
        d = d[:-1] + str((int(d[-1]) + 1 + rng.randrange(8)) % 10)
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    def name():
        return "".join(rng.choice("abcdefghij") for _ in range(6))

    hexes = lambda n: ":".join(f"{rng.randrange(4096, 65536):x}" for _ in range(n))
    right = [
        ("email", lambda: f"{name()}@{name()}.com"), ("email", lambda: f"{name()} (at) {name()} [dot] org"), ("email", lambda: f"{name()}[at]{name()}.net"),
        ("card", lambda: card(" ")), ("card", lambda: card(".")), ("card", lambda: card("/")), ("card", lambda: card(" -")),
        ("phone", lambda: f"+1 ({number(3)}) 555-{number(4)}"), ("phone", lambda: f"(9{number(2)}) 555-{number(4)}"),
        ("ip", lambda: f"10.{rng.randrange(256)}.1.2"), ("ip", lambda: hexes(8)), ("ip", lambda: f"2001:{hexes(2)}::1"),
    ]
    clean = [
        lambda: bad_card(""), lambda: bad_card("."), lambda: bad_card(" -"), lambda: f"20{rng.randrange(10, 30)}-0{rng.randrange(1, 10)}-1{rng.randrange(10)}",
        lambda: number(7), lambda: f"1{rng.randrange(10)}:2{rng.randrange(10)}:3{rng.randrange(10)}", lambda: ":".join(["a1", "b2", "c3", "d4", "e5", number(2)]),
        lambda: f"1.{rng.randrange(10)}.{rng.randrange(100)}", lambda: f"{name()}@{name()}", lambda: "5" + number(8),
    ]
    texts, want = [], {}
    for i in range(1800):
        if i % 3 == 2:
            texts.append((i, f"the {name()} was {rng.choice(clean)()} in {name()}."))
            continue
        kind, make = right[i % len(right)] if i % 3 else rng.choice(right)
        head, span = f"so {name()} has ", make()
        texts.append((i, f"{head}{span} for it. Then more"))
        want[i] = f"{kind}:{len(head)}:{len(head) + len(span)}"
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert {i: (t, got[i]) for i, t in texts if i not in want and got[i]} == {}
    assert {i: (t, want[i], got[i]) for i, t in texts if i in want and got[i] != want[i]} == {}


def test_pii_weak_labels():
    cases = [
        ("email", "jo (at) mail [dot] org", True), ("email", "jo@mail", False), ("email", "jo[at]mail.12", False), ("email", "jö@mail.org", None),
        ("ip", "fe80::1", True), ("ip", "00:1a:2b:3c:4d:5e", False), ("ip", "1.2.3", False), ("ip", "a::b", None),
        ("card", "4111.1111.1111.1111", True), ("card", "4111.1111.1111.1112", False), ("phone", "(942) 555-3625", True),
        ("phone", "942 555 3625", None), ("phone", "2020-01-02", False), ("phone", "555-3625", False),
    ]
    for kind, span, label in cases:
        assert pii.weak_label(f"a {span} b", kind, 2, 2 + len(span)) is label, (kind, span)
    assert pii.weak_label("call 942 555 3625", "phone", 5, 17) is True


def test_license_blocks_cross_lines_and_are_bounded(spark):
    rng = random.Random(31)
    wrapped = {}
    for i, (label, text) in enumerate(sorted(licenses.TEMPLATES.items())):
        lines, words = [], text.split()
        while words:
            n = rng.randrange(2, 6)
            lines.append(" * " + " ".join(words[:n]))
            words = words[n:]
        wrapped[i] = (label, prose(rng, 90) + "\n" + "\n".join(lines) + "\n" + prose(rng, 90))
    far = f"released {prose(rng, 40)} under {prose(rng, 40)} the mit {prose(rng, 40)} license"
    texts = [(i, t) for i, (_, t) in wrapped.items()] + [(100, far), (101, "released the\nnew mit\nlicense " + prose(rng, 50))]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, (label, _) in wrapped.items():
        assert label in got[i]["labels"].split(",") and got[i]["score"] == 1.0
    assert (got[100]["labels"], got[100]["score"]) == ("", 0.0) and (got[101]["labels"], got[101]["score"]) == ("mit,mit-notice", 0.8)

    def brute(text):
        split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
        words, best = split(text), {}
        for label, template in licenses.TEMPLATES.items():
            t, longest = set(split(template)), math.ceil(round(len(split(template)) / licenses.THRESHOLD, 6))
            share = max((len(t & set(words[i : i + longest])) for i in range(len(words))), default=0)
            if share >= math.ceil(round(licenses.THRESHOLD * len(t), 6)):
                best[label] = share / len(t)
        return best

    vocabulary = " ".join(licenses.TEMPLATES.values()).split()
    mixed = []
    for i in range(150):
        words = rng.choice(list(licenses.TEMPLATES.values())).split()
        words = [w for w in words for w in ([w] if rng.random() < 0.9 else [rng.choice(vocabulary), w] if rng.random() < 0.5 else [])]
        mixed.append((i, prose(rng, rng.randrange(9), vocabulary) + "\n" + " ".join(w + rng.choice(["\n", "", ""]) for w in words) + " " + prose(rng, rng.randrange(9), vocabulary)))
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(mixed, "doc_id long, text string")).collect()}
    found = 0
    for i, text in mixed:
        best = brute(text)
        found += bool(best)
        assert {b["label"] for b in got[i]["blocks"]} == set(best) and got[i]["score"] == max(best.values(), default=0.0)
    assert 50 < found < 150
