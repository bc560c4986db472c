"""Cases in which corpus operators once gave other results than their contracts."""

import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskengine.llm import chat, components, decontaminate, licenses, mixing, neardup, pii, quality, urls, warc
from riskengine.session import materialize


def test_revisits_are_resolved_by_id_and_digest(spark):
    x, y = "x" * 150, "y" * 200
    pages = spark.createDataFrame([(5, x), (5, y), (7, y), (9, x)], "page_id long, html string").withColumn("url", F.lit("http://h/"))
    got = sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.archive_and_read(pages).collect())
    dx, dy = hashlib.sha256(x.encode()).hexdigest(), hashlib.sha256(y.encode()).hexdigest()
    assert got == [
        (5, 150, dx, "response", None), (5, 200, dy, "response", None), (7, 200, dy, "revisit", 5), (9, 150, dx, "revisit", 5),
    ]


def test_equal_turn_numbers_go_by_text(spark):
    texts = ["a<|", "a<z", "a", "a\x01", "a\\", "<|im_end|>", "<\\|im_end|>"]
    turns = spark.createDataFrame([(1, 0, "user", t) for t in texts], "conv_id long, turn long, role string, text string")
    r = chat.read_back(chat.format_turns(turns)).first()
    want = "".join(f"user\n{t}\n" for t in sorted(texts, key=lambda t: t.encode()))
    assert r["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()


def test_link_farms_come_from_the_pages(spark):
    farm, page = '<a href="/x">x</a>' * 30, "<p>" + "word " * 400 + '<a href="/x">x</a>'
    rows = [(1, "http://www.Farm.org:80/a/", farm), (2, "https://farm.org/a?utm_source=x", page), (3, "http://farm.org/b", page)]
    rows += [(4, "http://farm.net/a", farm), (5, "http://farm.org/a?q=1", None), (6, None, farm), (7, "http://h.org/fr/", farm), (8, "http://h.org/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["verdict"], r["listed"], r["rule"]) for r in urls.judge_urls(pages, urls.link_farms(pages)).collect()}
    assert got == {
        1: ("block", True, None), 2: ("block", True, None), 3: ("allow", False, None), 4: ("block", True, "net/"),
        5: ("allow", False, None), 6: ("allow", False, None), 7: ("allow", True, "org/fr/"), 8: ("allow", False, None),
    }


def test_wrapped_notice_agrees_with_the_sql(spark, tmp_path):
    import duckdb

    from riskengine.llm.oracles import OP9

    label, text = next(iter(sorted(licenses.TEMPLATES.items())))
    words = text.split()
    wrapped = "\n".join(" ".join(words[k : k + 4]) for k in range(0, len(words), 4))
    spread = " filler ".join(words)
    docs = [(1, f"Intro line\n{wrapped}\nmore"), (2, wrapped), (3, " ".join(words[: len(words) // 2])), (4, spread * 3), (5, None), (6, f"{wrapped} {wrapped}")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = licenses.scan_licenses(frame).drop("blocks")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    rel = con.execute(OP9)
    columns = [d[0] for d in rel.description]
    want = sorted(tuple(r[columns.index(c)] for c in got.columns) for r in rel.fetchall())
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == want
    assert [r[got.columns.index("score")] for r in rows][:2] == [1.0, 1.0] and label in rows[0][got.columns.index("labels")]


def test_helper_names_do_not_clash_with_columns(spark):
    """Columns named like the operators' own helpers come back with their values."""
    text = " ".join(f"word{i}" for i in range(60))
    names = ["_quality", "_copy", "_n", "_s_id", "_s_key", "_spans", "_bad_id", "_bad_key", "_s", "_parts", "_k", "_mix_n", "_p_source", "kept", "spans"]
    rows = [(i, f"{text} {i} " + f"tail{i} " * 50 + "mail a.b@example.org", "web", *[f"v{i}"] * len(names)) for i in range(6)]
    rows += [rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([(1, " ".join(f"tail{2}" for _ in range(12)))], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")

    def values(frame):
        assert set(names) <= set(frame.columns)
        return {r["doc_id"]: {r[n] for n in names} for r in frame.select("doc_id", *names).collect()}

    whole = {i: {f"v{i}"} for i in range(6)}
    assert values(neardup.keep_one_of_each(docs)).items() <= whole.items()
    assert values(decontaminate.drop_contaminated(docs, items)) == {i: v for i, v in whole.items() if i != 2}
    assert values(mixing.pfair_mix(docs)) == whole
    assert values(quality.keep_good(docs, labels, threshold=0.0)) == whole
    redacted = pii.redact(docs)
    assert values(redacted) == whole and redacted.where("text like '%[EMAIL]%'").count() == 7


def test_positional_filter_leaves_a_block_to_its_first_common_word(spark):
    cases = [
        ("a b c d x", 0, True),  # four of five from the rarest word on
        ("a b c d x", 1, False),  # three from the second on: found through the first
        ("b c d e x", 1, True),
        ("a b c x y", 0, False),
    ]
    df = spark.createDataFrame([(n.split(), list("abcde"), p, w) for n, p, w in cases], "near array<string>, template array<string>, place int, want boolean")
    held = licenses._enough_follow(F.col("near"), F.col("template"), F.col("place"), F.lit(4))
    assert df.where(held != F.col("want")).count() == 0


def test_the_fit_holds_columns_alone():
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(quality.COLUMNS, 1_000, replace=False)).astype(np.int32) for _ in range(2_000)]
    good = rng.random(len(rows)) < 0.5
    ratio = quality.log_count_ratio(rows, good)
    tracemalloc.start()
    weights, _ = quality.dual_coordinate_descent(rows, ratio, good, epochs=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000  # entries of all rows at once are 16 MB
    assert weights.any() and quality.grams(b"some words of a text").dtype.itemsize == 4


def test_sketches_and_sets_leave_a_batch_in_parts():
    class Docs:
        def mapInArrow(self, work, schema):
            return work

    texts = [f"text {i} " + " ".join(f"w{i * 7 + k}" for k in range(300)) for i in range(3_000)]
    texts[5], texts[6], texts[7] = None, "", "long " * 600_000
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    found = [s.view(np.int64) for s in neardup.batch_shingles(batch.column("text"), 5)]
    sets = list(neardup.shingle_sets(Docs(), 5)(iter([batch])))
    sketches = list(neardup.sketched(Docs(), 5)(iter([batch])))
    assert max(b.nbytes for b in sets) < 4_000_000 and max(b.nbytes for b in sketches) < 2_000_000
    rows = [r for b in sets for r in zip(b.column("id").to_pylist(), b.column("shingles").to_pylist())]
    assert rows == [(i, s.tolist()) for i, s in enumerate(found)]
    sizes = [r for b in sketches for r in zip(b.column("doc_id").to_pylist(), b.column("n_shingles").to_pylist())]
    assert sizes == [(i, len(s)) for i, s in enumerate(found)]


def test_narrow_tables_are_few_files(spark):
    made = spark.range(5_000).repartition(64, "id").selectExpr("id", "id % 7 as v")
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        links = neardup._verified(
            made.select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")),
            spark.range(5_001).select("id", F.array(F.lit(1)).alias("shingles")),
            80,
        )
        narrow = materialize(links, "test-narrow", narrow=True)
        assert len(materialize(links, "test-wide").inputFiles()) == 64
        assert len(narrow.inputFiles()) <= spark.sparkContext.defaultParallelism
        assert sorted(narrow.collect()) == [(i, i + 1) for i in range(5_000)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_components_end_with_stars(spark, monkeypatch):
    written = []

    def counted(df, tag, **more):
        written.append(tag)
        return materialize(df, tag, **more)

    monkeypatch.setattr(components, "materialize", counted)

    def found(links):
        written.clear()
        return sorted(tuple(r) for r in components.components(spark.createDataFrame(links, "u long, v long")).collect())

    assert found([(2, 1), (1, 3), (5, 4), (5, 4), (6, 6)]) == [(2, 1), (3, 1), (5, 4)]
    assert len(written) == 1  # stars need no round
    assert found([]) == [] and len(written) == 1
    assert found([(1, 2), (2, 3)]) == [(2, 1), (3, 1)] and len(written) == 2  # no round to see that nothing moves
    assert found([(3, 1), (3, 2)]) == [(2, 1), (3, 1)]
    rng = np.random.default_rng(11)
    for n in (40, 90):
        links = [tuple(int(x) for x in pair) for pair in rng.integers(0, n, (n * 2 // 3, 2))] + [(k, k + 1) for k in range(200, 200 + n)]
        parent = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for u, v in links:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
        assert found(links) == sorted((x, root(x)) for x in parent if root(x) != x)
