"""Operator 2: personal data by format rules and boosted trees over candidate spans.

Base spans follow fixed formats and are always kept. High-recall generators propose further,
overlapping spans per kind (obfuscated or cut-off addresses, numbers with odd separators and
lengths). Boosted trees score each proposal by its format and its context. They learn from the
proposals of the corpus themselves, weakly labelled by their normal form and not by the base rule:
a proposal is right if the form is valid (a domain, a checksum, IPv6 groups, a telephone number
with a cue), wrong if it cannot be, and without a label, so in neither fit nor calibration, where
neither is sure. All labelled proposals are used: two thirds, by a hash of text and place, to fit
the trees, with their split points, and one third to calibrate the threshold of each kind, so that
at least PRECISION of what is selected there is right, both of all proposals and of those beyond the
base rule. Equal proposals are one row with their number. In the fit a kind, label and base of more
than LEVEL proposals weighs as LEVEL of them, so that frequent forms do not drown rare ones. Trees
and thresholds judge every proposal, whatever its weak label. Selected ones that do not overlap a
base span or a better proposal are added.

Every whole text is scanned once; texts without a digit, `@` or written-out at sign are only
searched for one. Proposals are a small table: they are scored by the trees in Spark ML and come
back to their documents by a join on ids.

Defined results: a null text is empty; without proposals of both labels nothing is learned and
only base spans count; equal scores go by place; rows that share doc_id and text get equal
results, one row each; a null doc_id is an id like others; empty tables give no rows; other
columns are carried by `redact` and not by `find_pii`.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.llm.common import carrying, kept_as, whole_text
from riskengine.session import materialize

KINDS = ("email", "ip", "card", "phone")
# The formats of the base rule. A match of `ip` ends where its digits do, so that the
# next one starts at the head of a run of digits; saying so keeps long runs from being tried at
# each of their digits. `email` is searched from its at signs, for the same reason.
EMAIL_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
BASE = {
    "ip": re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# Generators of proposals. A plain dot with a space on one side only ends a sentence.
_AT = r"(?:\s?(?:@|\((?i:at)\)|\[(?i:at)\])\s?)"
_DOT = r"(?:\.|\s\.\s|\s?(?:\((?i:dot)\)|\[(?i:dot)\])\s?)"
LOOSE = {
    "email": re.compile(rf"[\w.%+-]{{1,64}}(?:\s?[(\[](?i:dot)[)\]]\s?[\w.%+-]{{1,64}}){{0,3}}{_AT}[\w-]{{1,63}}(?:{_DOT}[\w-]{{1,63}}){{0,6}}"),
    "ip": re.compile(
        r"[0-9]{1,4}(?:\.[0-9]{1,4}){2,5}"
        r"|(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:|::)(?:[0-9A-Fa-f]{0,4}:){0,7}(?:[0-9A-Fa-f]{1,4}|(?<=::))(?![\w])"
    ),
    "card": re.compile(r"[0-9](?:[\x20./-]{0,2}[0-9]){11,22}"),
    "phone": re.compile(r"\(?\+?\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,15}"),
}
MARKED = re.compile(r"[0-9@]|[(\[](?i:at)[)\]]|[A-Fa-f]:[A-Fa-f:]|::[A-Fa-f]")
# Words before a number that say it is a telephone's.
CUE = re.compile(r"(?i)(?:\b(?:tel|ph|phone|telephone|mobile|cell|fax|whatsapp|sms|call|dial|ring|telefon|tel[eé]fono|t[eé]l[eé]phone|handy|m[oó]vil)\b)\W*(?:\w+\W+)?$")
AREA_CODE = re.compile(r"\([0-9]{2,5}\)")
DATE = re.compile(
    r"(?:1[0-9]|20)[0-9]{2}([./-]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])(?![0-9])"
    r"|(?:0?[1-9]|[12][0-9]|3[01])([./-])(?:0?[1-9]|[12][0-9]|3[01])\2(?:1[0-9]|20)[0-9]{2}(?![0-9])"
)
NORMAL_LOCAL = re.compile(r"[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*")
NORMAL_DOMAIN = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}")
CARD_GROUPS = re.compile(r"[0-9]{16,19}|[0-9]{4}([\x20./-]{1,2})(?:[0-9]{4}\1){2}[0-9]{4}(?:\1?[0-9]{1,3})?")
CONTEXT = 12
LEVEL = 3_000
PRECISION = 0.98
TREES, DEPTH = 12, 3
# Split points of a feature, and rows of a fit in one task.
BINS = 32
ROWS_PER_TASK = 20_000
FEATURES = (
    "is_email", "is_ip", "is_card", "is_phone", "length", "digits", "letters", "dots", "spaces", "hyphens",
    "brackets", "plus", "at", "luhn", "largest_part", "parts", "word_before", "word_after", "digit_near",
    "quote_near", "equals_near", "edge_near", "normal_dots", "last_letters", "colons", "gap", "cue", "area_code", "even_groups", "date",
)

_SPAN = "struct<kind:string,start:int,end:int>"
_SPAN_TYPE = T.StructType().add("kind", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType())
_CANDIDATE = "struct<kind:string,start:int,end:int,base:boolean,label:boolean,x:array<double>>"


def luhn(digits: str) -> bool:
    """Whether the number passes the checksum of payment cards."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def _valid(kind: str, span: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in span.split("."))
    if kind == "card":
        digits = _digits(span)
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(_digits(span)) <= 15
    return True


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping spans of a local part, `@` and a domain with a dot."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base rule, by kind as listed, then start."""
    found = [("email", *span) for span in emails(text)]
    for kind in KINDS[1:]:
        found += [(kind, m.start(), m.end()) for m in BASE[kind].finditer(text) if _valid(kind, m.group())]
    return found


def normal_form(kind: str, span: str) -> str:
    """The span without disguise: at and dot signs put back in addresses, separators taken out of numbers."""
    if kind == "email":
        span = re.sub(r"\s?(?:@|[(\[](?i:at)[)\]])\s?", "@", span)
        return re.sub(r"\s\.\s|\s?[(\[](?i:dot)[)\]]\s?", ".", span)
    return span.lower() if kind == "ip" else _digits(span)


def has_cue(text: str, start: int) -> bool:
    return CUE.search(text[max(0, start - 2 * CONTEXT) : start]) is not None


def weak_label(text: str, kind: str, start: int, end: int) -> bool | None:
    """Whether the normal form is valid (True), cannot be (False), or may be either (None)."""
    span = text[start:end]
    form = normal_form(kind, span)
    if kind == "email":
        local, _, domain = form.rpartition("@")
        if not form.isascii():
            return None
        if "@" in local or not NORMAL_LOCAL.fullmatch(local.lstrip(".")):
            return False
        if NORMAL_DOMAIN.fullmatch(domain):
            return True if local[0] != "." else None
        # Without a dot, or with a number in place of a top-level domain, no mail can be sent there.
        return None if "." in domain and domain.rpartition(".")[2].isalpha() else False
    if kind == "ip" and ":" in span:
        try:
            ipaddress.IPv6Address(form)
        except ValueError:
            return False
        groups = [g for g in form.split(":") if g]
        # Short ones of letters alone, such as a::b, are names in code as well.
        return True if len(groups) >= 2 and any(c.isdigit() for c in form) else None
    # A piece of a longer number or name is none of the others.
    if (start and text[start - 1].isalnum()) or text[end : end + 1].isalnum():
        return False
    if kind == "ip":
        return span.count(".") == 3 and _valid("ip", span)
    if kind == "card":
        if not _valid("card", form):
            return False
        return True if CARD_GROUPS.fullmatch(span) else None
    if not _valid("phone", form) or (DATE.match(span) and "+" not in span):
        return False
    if span.count(".") == 3 and re.fullmatch(r"[0-9.]+", span) and _valid("ip", span):
        return False
    return True if "+" in span or AREA_CODE.search(span) or has_cue(text, start) else None


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span, in the order of FEATURES."""
    span = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = _digits(span)
    parts = [p for p in re.split(r"[^0-9A-Za-z]+", span) if p]
    numbers = [min(int(p), 99999) for p in parts if p.isascii() and p.isdigit() and len(p) <= 20]
    near = before + after
    form = normal_form(kind, span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    return [
        *(float(kind == k) for k in KINDS),
        float(end - start),
        float(len(digits)),
        float(sum(c.isalpha() for c in span)),
        float(span.count(".")),
        float(span.count(" ")),
        float(span.count("-")),
        float(sum(c in "()[]" for c in span)),
        float("+" in span),
        float("@" in span),
        float(bool(digits) and luhn(digits)),
        float(max(numbers, default=-1)),
        float(len(parts)),
        float(bool(before) and (before[-1].isalnum() or before[-1] in "_.-+")),
        float(bool(after) and (after[0].isalnum() or after[0] in "_-@")),
        float(sum("0" <= c <= "9" for c in near)),
        float(sum(c in "\"'`" for c in near)),
        float("=" in before),
        float(not before or not after or "\n" in near),
        float(form.rpartition("@")[2].count(".")),
        float(len(re.search(r"[A-Za-z]*$", form)[0])),
        float(span.count(":")),
        float("::" in span),
        float(has_cue(text, start)),
        float(AREA_CODE.search(span) is not None),
        float(len(groups) < 2 or set(groups[:-1]) == {4}),
        float(DATE.match(span) is not None),
    ]


def proposals(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Candidate spans of all generators with features; `base` marks those the base rule gives too."""
    known = set(base)
    spans = dict.fromkeys(base)
    for kind in KINDS:
        spans.update(dict.fromkeys((kind, m.start(), m.end()) for m in LOOSE[kind].finditer(text)))
    return [
        {"kind": k, "start": s, "end": e, "base": (k, s, e) in known, "label": weak_label(text, k, s, e), "x": describe(text, k, s, e)}
        for k, s, e in spans
    ]


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base spans and candidates of each text (doc_id, text)."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key long, base array<{_SPAN}>, candidates array<{_CANDIDATE}>"
    arrow = docs.sparkSession.createDataFrame([], schema).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        for batch in batches:
            bases, candidates = [], []
            for text in batch.column("text").to_pylist():
                found = base_spans(text) if MARKED.search(text) else []
                bases.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                candidates.append(proposals(text, found) if MARKED.search(text) else [])
            columns = [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array(bases, to_arrow_type(arrow["base"].dataType)),
                pa.array(candidates, to_arrow_type(arrow["candidates"].dataType)),
            ]
            yield pa.RecordBatch.from_arrays(columns, arrow.names)

    keyed = docs.select("doc_id", F.xxhash64(whole_text("text")).alias("text_key"), whole_text("text").alias("text"))
    return keyed.mapInArrow(work, schema)


def split_points(rows: DataFrame) -> list[tuple[int, float]]:
    """(feature, value) for each value of a feature but its least, of all `rows` (x, heft).

    A feature of more than BINS values has the first of each of BINS parts of equal heft. Spark's
    trees would take theirs from a draw of rows.
    """
    values = rows.select("heft", F.posexplode("x").alias("i", "v")).groupBy("i", "v").agg(F.sum("heft").alias("heft"))
    feature = Window.partitionBy("i")
    rising = feature.orderBy("v")
    placed = values.select(
        "i",
        "v",
        F.row_number().over(rising).alias("place"),
        F.count("v").over(feature).alias("n"),
        ((F.sum("heft").over(rising) - F.col("heft")) / F.sum("heft").over(feature)).alias("below"),
    )
    part = F.when(F.col("n") <= BINS, F.col("place")).otherwise(F.floor(F.col("below") * BINS))
    firsts = placed.groupBy("i", part.alias("part")).agg(F.min("v").alias("v"), F.min("place").alias("place"))
    return sorted((r["i"], r["v"]) for r in firsts.where("place > 1").collect())


def _flags(df: DataFrame, points: list[tuple[int, float]]) -> DataFrame:
    """`df` with `features`: for each split point whether the feature reaches it, declared as binary."""
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(v).alias("v")) for i, v in points))
    reached = F.transform(steps, lambda s: (F.get("x", s["i"]) >= s["v"]).cast("double"))
    declared = {"attrs": {"binary": [{"idx": k} for k in range(len(points))]}, "num_attrs": len(points)}
    return df.withColumn("features", array_to_vector(reached)).withMetadata("features", {"ml_attr": declared})


def learned_spans(candidates: DataFrame) -> DataFrame:
    """Candidates beyond the base spans that the boosted trees select, with their scores.

    `candidates` has doc_id, text_key, kind, start, end, base, label, x.
    """
    none = candidates.where(F.lit(False)).withColumn("score", F.lit(0.0)).drop("x")
    held = (F.pmod(F.xxhash64("text_key", "start"), F.lit(3)) == 0).alias("held")
    alike = candidates.where("label is not null").groupBy("kind", "label", "base", held, "x").agg(F.count(F.lit(1)).alias("n"))
    alike = materialize(alike, "pii-labelled")
    # At most four kinds by two labels by base or not.
    fit = alike.where("not held")
    strata = fit.groupBy("kind", "label", "base").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    if len({r["label"] for r in strata}) < 2:
        return none
    # Whole billionths, whose sums do not depend on their order.
    heft = F.lit(0)
    for r in strata:
        same = (F.col("kind") == r["kind"]) & (F.col("label") == r["label"]) & (F.col("base") == r["base"])
        heft = F.when(same, F.col("n") * F.lit(max(1, 10**9 * min(LEVEL, r["n"]) // r["n"]))).otherwise(heft)
    fit = fit.withColumn("heft", heft)
    points = split_points(fit) or [(0, 0.0)]
    weighed = _flags(fit, points).select("features", F.col("label").cast("double").alias("label"), (F.col("heft") / 1e9).alias("weight"))
    # A few tasks are enough for few rows, and rounds of boosting stay short.
    tasks = max(4, -(-sum(r["rows"] for r in strata) // ROWS_PER_TASK))
    booster = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=BINS, seed=11, weightCol="weight")
    model = booster.fit(weighed.coalesce(tasks))
    chance = vector_to_array("probability")[1]

    # Per kind the smallest hundredth at and above which the held-out precision is high enough.
    graded = model.transform(_flags(alike.where("held"), points)).select("kind", "base", "label", "n", F.floor(chance * 100).alias("grade"))
    right, beyond = F.col("label").cast("long") * F.col("n"), (~F.col("base")).cast("long")
    sums = [F.sum(x).alias(n) for n, x in (("right", right), ("all", F.col("n")), ("new_right", right * beyond), ("new", F.col("n") * beyond))]
    by_grade = graded.groupBy("kind", "grade").agg(*sums).collect()
    least = {}
    for kind in KINDS:
        total = [0] * 4
        for r in sorted((r for r in by_grade if r["kind"] == kind), key=lambda r: -r["grade"]):
            total = [t + r[c] for t, c in zip(total, ("right", "all", "new_right", "new"))]
            if total[0] >= PRECISION * total[1] and total[2] >= PRECISION * total[3]:
                least[kind] = r["grade"] / 100
    if not least:
        return none
    above = F.lit(False)
    for kind, value in least.items():
        above = above | ((F.col("kind") == kind) & (F.col("score") >= value))
    scored = model.transform(_flags(candidates.where("not base"), points)).withColumn("score", chance)
    return scored.where(above).select(*(c for c in candidates.columns if c != "x"), "score")


def apart(base: list[dict], added: list[dict]) -> list[dict]:
    """`added` spans, best first, without those that overlap base spans or better ones."""
    starts, ends = [], []
    for s, e in sorted((b["start"], b["end"]) for b in base):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    kept = []
    for span in added:
        place = bisect_left(starts, span["end"])
        if place == 0 or ends[place - 1] <= span["start"]:
            starts.insert(place, span["start"])
            ends.insert(place, span["end"])
            kept.append({k: span[k] for k in ("kind", "start", "end")})
    return kept


@F.arrow_udf(T.ArrayType(_SPAN_TYPE))
def _apart(base: pa.Array, added: pa.Array) -> pa.Array:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    return pa.array([apart(b, a) for b, a in zip(base.to_pylist(), added.to_pylist())], pa.list_(span))


def with_placeholders(text: str, spans: list[dict]) -> str:
    """`text` with each span replaced by its kind; of spans that overlap, the first stands for all."""
    pieces, at = [], 0
    for start, end, kind in sorted((s["start"], s["end"], s["kind"]) for s in spans):
        if start >= at:
            pieces += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(pieces) + text[at:]


@F.arrow_udf(T.StringType())
def _with_placeholders(text: pa.Array, spans: pa.Array) -> pa.Array:
    pairs = zip(text.to_pylist(), spans.to_pylist())
    return pa.array([None if t is None else with_placeholders(t, s) for t, s in pairs], pa.string())


def document_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base and spans (arrays of kind, start, end) of each row of (doc_id, text)."""
    found = materialize(scanned(kept_as(docs, doc_id="doc_id", text="text")), "pii-candidates")
    candidates = (
        found.where(F.size("candidates") > 0)
        .dropDuplicates(["doc_id", "text_key"])
        .select("doc_id", "text_key", F.explode("candidates").alias("c"))
        .select("doc_id", "text_key", "c.*")
    )
    best = F.struct((-F.col("score")).alias("order"), "start", "end", "kind")
    added = (
        learned_spans(candidates)
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_list(best)).alias("added"))
        .select(F.col("doc_id").alias("a_id"), F.col("text_key").alias("a_key"), "added")
    )
    same = F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("text_key") == F.col("a_key"))
    none = F.array().cast("array<struct<order:double,start:int,end:int,kind:string>>")
    joined = found.drop("candidates").join(added, same, "left").withColumn("added", F.coalesce("added", none))
    return joined.select("doc_id", "text_key", "base", F.concat("base", _apart(F.col("base"), F.col("added"))).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end of each span by kind as listed, then start, joined by commas."""
    order = F.array(*(F.lit(k) for k in KINDS))
    keyed = F.transform(
        spans,
        lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("kind")),
    )
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["s"].cast("string"), s["e"].cast("string"))), ","
    )


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, spans, and the base rule's counts and list, for documents (doc_id, text)."""
    spans = document_spans(docs)
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS
    ]
    return spans.select("doc_id", *counts, span_list(F.col("base")).alias("base_list"), span_list(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with each found span replaced by its kind, such as [EMAIL]; other columns as they are."""
    return carrying(docs, ("doc_id", "text"), _redacted)


def _redacted(docs: DataFrame) -> DataFrame:
    spans = (
        document_spans(docs)
        .where(F.size("spans") > 0)
        .dropDuplicates(["doc_id", "text_key"])
        .select(F.col("doc_id").alias("_s_id"), F.col("text_key").alias("_s_key"), F.col("spans").alias("_spans"))
    )
    # Written first, so that the join knows its size and a small one leaves the texts in place.
    spans = materialize(spans, "pii-spans")
    same = docs["doc_id"].eqNullSafe(F.col("_s_id")) & (F.xxhash64(whole_text(docs["text"])) == F.col("_s_key"))
    joined = docs.join(spans, same, "left")
    # Only texts with spans go to Python.
    touched = F.col("_spans").isNotNull()
    written = _with_placeholders(F.when(touched, F.col("text")), F.col("_spans"))
    return joined.withColumn("text", F.when(touched, written).otherwise(F.col("text"))).select(docs.columns)
