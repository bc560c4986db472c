"""Selection, separation and replacement of personal-data spans."""

import random
import time

from pyspark.sql import functions as F

from riskengine.llm import pii


def test_spans_are_kept_apart_as_by_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        def spans(n):
            starts = [rng.randrange(60) for _ in range(n)]
            return [{"kind": rng.choice(pii.KINDS), "start": s, "end": s + rng.randrange(1, 9)} for s in starts]

        base, added = spans(rng.randrange(5)), spans(rng.randrange(12))
        want = []
        for a in added:
            if all(o["end"] <= a["start"] or a["end"] <= o["start"] for o in base + want):
                want.append(a)
        assert pii.apart(base, added) == want


def test_placeholders_cover_overlaps_and_stay_linear():
    def span(kind, start, end):
        return {"kind": kind, "start": start, "end": end}

    assert pii.with_placeholders("abcdefgh", [span("ip", 3, 6), span("email", 1, 4)]) == "a[EMAIL]gh"
    assert pii.with_placeholders("", []) == "" and pii.with_placeholders("é1", [span("card", 1, 2)]) == "é[CARD]"
    many = [span("email", 10 * i, 10 * i + 9) for i in range(200_000)]
    begun = time.monotonic()
    text = pii.with_placeholders("x" * 2_000_000, many)
    assert text == "[EMAIL]x" * 200_000 and pii.apart(many, many) == [] and len(pii.apart([], many)) == 200_000
    assert time.monotonic() - begun < 20


def test_texts_of_many_spans_are_redacted(spark):
    text = " ".join(f"m{i}@x{i}.org" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, "none"), (2, "a.b@c.de"), (2, "a.b@c.de"), (None, "call +1 942 555 3625"), (3, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in pii.redact(docs).collect())
    assert got == [(0, "call [PHONE]"), (1, " ".join(["[EMAIL]"] * 20_000)), (2, "[EMAIL]"), (2, "[EMAIL]"), (2, "none"), (3, "")]


def _proposals(spark, rows):
    x = "array_repeat(0D, {n})".format(n=len(pii.FEATURES))
    made = spark.createDataFrame(rows, "doc_id long, base boolean, label boolean, mark double")
    return made.select(
        "doc_id", F.xxhash64("doc_id").alias("text_key"), F.lit("phone").alias("kind"), F.lit(0).alias("start"), F.lit(9).alias("end"),
        "base", "label", F.concat(F.array("mark"), F.expr(x)).alias("x"),
    )


def test_trees_judge_proposals_of_every_weak_label(spark):
    """Form 1 is right but for a rare wrong label, form 0 wrong but for a rare unknown."""
    rows = [(i, False, None if i % 97 == 1 else i % 2 == 0 or i % 331 == 0, float(i % 2 == 0)) for i in range(3000)]
    rows += [(10_000, False, False, 1.0), (10_001, False, None, 1.0), (10_002, False, False, 0.0)]
    got = {r["doc_id"] for r in pii.learned_spans(_proposals(spark, rows)).select("doc_id").collect()}
    assert {10_000, 10_001} <= got and 10_002 not in got
    assert {i for i in got if i < 3000} == set(range(0, 3000, 2))


def test_thresholds_ask_for_precision_beyond_the_base_rule(spark):
    """Right base spans by the thousand do not carry wrong proposals of the same form."""
    rows = [(i, True, True, 1.0) for i in range(3000)] + [(3000 + i, False, i % 10 != 0, 1.0) for i in range(200)]
    rows += [(4000 + i, False, False, 0.0) for i in range(400)]
    assert pii.learned_spans(_proposals(spark, rows)).count() == 0


def _proposals_of(rows):
    x = f"concat(array(mark), array_repeat(0D, {len(pii.FEATURES)}))"
    return rows.selectExpr("doc_id", "xxhash64(doc_id) AS text_key", "'phone' AS kind", "0 AS start", "9 AS end", "base", "label", f"{x} AS x")


def test_trees_and_thresholds_see_every_labelled_proposal(spark):
    """Nine wrong proposals of a form of their own, among 120,000 of another, are learned from."""
    rows = spark.range(120_000).selectExpr("id AS doc_id", "false AS base", "false AS label", "0D AS mark")
    rows = rows.unionAll(spark.range(200_018, 200_027).selectExpr("id", "false", "false", "2D"))
    rows = rows.unionAll(spark.range(300_000, 300_400).selectExpr("id", "false", "true", "3D"))
    got = {r["doc_id"] for r in pii.learned_spans(_proposals_of(rows)).select("doc_id").collect()}
    assert got == set(range(300_000, 300_400))


def test_split_points_come_from_all_rows(spark):
    """Each value of a small feature, however rare; parts of equal heft of a large one."""
    rows = spark.range(100_000).selectExpr("array(double(id), IF(id = 77777, 1D, 0D), 5D) AS x", "1L AS heft")
    points = pii.split_points(rows)
    assert points == [(0, float(-(-k * 100_000 // pii.BINS))) for k in range(1, pii.BINS)] + [(1, 1.0)]
