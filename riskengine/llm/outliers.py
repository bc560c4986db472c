"""Operator 4: text statistics, and robust outliers per language and source.

Texts that pass the fixed rules are compared within their (language, source) by five transformed
statistics. Each group gets a minimum-covariance-determinant estimate of centre and covariance: from
several fixed starts on, concentration steps take the h = 75 % of texts with the smallest distances
as the next estimate, for as long as the determinant of its covariance falls; of all starts, the end
with the least determinant is the estimate. Languages and all texts together get estimates in the
same way, and a group's is drawn towards its language's, and that towards the one of all texts, with
the weight of SHRINK texts: a group of a few texts is measured almost as its language, one of
thousands by itself, with one rule for all sizes. Texts far out by Mahalanobis distance are rejected.
Everything is DataFrame expressions: the words of a text never leave its row, and each step is one
aggregate over a narrow table, so that a hot group is summed up on the map side.

Defined results: a null text is empty; texts without words fail the base rules; null languages and
sources are groups of their own; a group or language without passing texts is measured as what it is
drawn towards; if no text passes the base rules there is no estimate, and all distances are null; ties at the edge of the 75 % subset are all in it; repeated rows each count and
each get a verdict; an empty table gives an empty result; other columns are not carried.
A 5-word window is identified by a 64-bit hash of its words within its own text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.common import kept_as, space_words, whole_text
from riskengine.session import materialize

WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Statistics and the standard deviation that each is granted at least: most texts of a group
# have exactly none of some of them, and their covariance would be singular.
STATISTICS = {"s_length": 0.06, "s_symbols": 0.04, "s_upper": 0.05, "s_lines": 0.1, "s_repeats": 0.1}
# The lower triangle of a covariance, and the names of its factor's columns.
PAIRS = [(i, j) for i in range(len(STATISTICS)) for j in range(i + 1)]
_FACTORS = [f"l{i}{j}" for i, j in PAIRS]
SUBSET = 0.75
# Fixed value: 0.75 / P(chi2 with 7 degrees <= 6.626), where 6.626 is the 75 % point with 5 degrees.
CONSISTENCY = 1.413
# Squared distance beyond which a text is rejected; a normal vector exceeds it once in 3 * 10^10.
CUTOFF = 58.0
# All starts take this many steps; the KEPT best of each group then go on until the logarithm of the
# determinant falls by less than TOLERANCE, MAX_STEPS at most.
TRIAL_STEPS, KEPT, MAX_STEPS, TOLERANCE = 2, 2, 30, 1e-4
# Texts that the wider estimate counts for.
SHRINK = 50.0
# Quantiles are read from histograms, rounded up to a bin edge.
VALUE_BINS = 200.0
DISTANCE_BINS = 64.0


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base counts, n_lines and n_upper of each text (column `text`)."""
    texts = docs.withColumn("text", whole_text("text")).withColumn("words", space_words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = texts.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.translate("text", UPPER, ""))).cast("long").alias("n_upper"),
        lines.alias("lines"),
        F.when(
            F.size("words") >= WINDOW_WORDS,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - WINDOW_WORDS),
                lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW_WORDS))),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
    )
    # Only texts with a repeated window pay for sorting their windows.
    sortable = counted.select(
        "doc_id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_upper",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("runs"),
    )
    repeated = sortable.withColumn(
        "starts",
        F.array_sort(
            F.filter(
                F.transform(
                    "runs",
                    lambda x, j: F.when(
                        (x["h"] == F.get("runs", j - 1)["h"]) | (x["h"] == F.get("runs", j + 1)["h"]), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
        ),
    )
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda s, i: F.struct(
            (i + WINDOW_WORDS).alias("upto"),
            (s["n"] + F.least(F.lit(WINDOW_WORDS), i + WINDOW_WORDS - s["upto"])).alias("n"),
        ),
        lambda s: s["n"],
    )
    return repeated.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("runs", "starts")


def with_vector(stats: DataFrame) -> DataFrame:
    """The transformed statistics; small constants keep short texts near the middle."""
    share = lambda part, whole, more: F.sqrt(F.col(part) / (F.col(whole) + F.lit(more)))
    return (
        stats.withColumn("s_length", F.log((F.col("word_chars") + 100.0) / (F.col("n_words") + 20.0)))
        .withColumn("s_symbols", share("n_symbols", "word_chars", 100.0))
        .withColumn("s_upper", share("n_upper", "word_chars", 100.0))
        .withColumn("s_lines", share("n_dup_lines", "n_lines", 5.0))
        .withColumn("s_repeats", share("n_repeat_words", "n_words", 20.0))
    )


def _quantile_bin(binned: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Per key the smallest `bin` that has `share` of the rows at or below it; exact, and bounded."""
    counts = binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("bin")
    whole = Window.partitionBy(*keys)
    return (
        counts.withColumn("upto", F.sum("n").over(upto))
        .withColumn("all", F.sum("n").over(whole))
        .where(F.col("upto") >= F.lit(share) * F.col("all"))
        .groupBy(*keys)
        .agg(F.min("bin").alias("bin"))
    )


def _cholesky(cov, size: int) -> dict[tuple[int, int], Column]:
    """Lower triangle L with L L' = cov, as expressions over already named columns."""
    lower: dict[tuple[int, int], Column] = {}
    for i in range(size):
        for j in range(i + 1):
            rest = cov(i, j)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            lower[i, j] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
    return lower


def _with_pools(rows: DataFrame) -> DataFrame:
    """Adds `pools`: the keys of a row's group, its language and all texts."""
    key = lambda level, *cols: F.concat(F.lit(level), F.to_json(F.struct(*cols)) if cols else F.lit(""))
    return rows.withColumn("pools", F.array(key("group ", "lang", "source"), key("lang ", "lang"), key("all")))


def _factored(estimates: DataFrame) -> DataFrame:
    """Adds l**, the Cholesky factor of the covariance c, and the logarithm of its determinant."""
    size = len(STATISTICS)
    place = {pair: k for k, pair in enumerate(PAIRS)}
    out = estimates
    for (i, j), value in _cholesky(lambda i, j: F.get("c", F.lit(place[i, j])), size).items():
        out = out.withColumn(f"l{i}{j}", value)
    return out.withColumn("logdet", sum((2 * F.log(f"l{i}{i}") for i in range(size)), F.lit(0.0)))


def _with_distance(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with `distance`, the squared Mahalanobis distance by each estimate of their `pool`."""
    joined = rows.join(estimates, "pool", how)
    total = F.lit(0.0)
    for i, name in enumerate(STATISTICS):
        rest = F.col(name) - F.get("m", F.lit(i))
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        joined = joined.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
        total = total + F.col(f"y{i}") * F.col(f"y{i}")
    more = [c for c in ("start",) if c in estimates.columns]
    return joined.withColumn("distance", total).select(*rows.columns, *more, "distance")


def _granted(products: list[Column]) -> Column:
    """The lower triangle of a covariance, with what each statistic is granted added to its diagonal."""
    least = list(STATISTICS.values())
    return F.array(*(v + F.lit(least[i] ** 2) if i == j else v for (i, j), v in zip(PAIRS, products)))


def _starts(points: DataFrame) -> DataFrame:
    """Four first estimates per pool: pool, n, start, m, c.

    By the medians: the granted variances alone, the products of signs (all deviations at length 1),
    and those of squashed deviations; and the plain mean and covariance.
    """
    names, least = list(STATISTICS), list(STATISTICS.values())
    long = points.select("pool", F.posexplode(F.array(*(F.ceil(F.col(n) * VALUE_BINS) for n in names))).alias("stat", "bin"))
    medians = (
        _quantile_bin(long, ["pool", "stat"], 0.5)
        .groupBy("pool")
        .agg(*(F.max(F.when(F.col("stat") == i, F.col("bin") / VALUE_BINS)).alias(f"m{i}") for i in range(len(names))))
    )
    # As with the edges below.
    centred = points.join(materialize(medians, "outlier-medians"), "pool").withColumns(
        {f"z{i}": (F.col(n) - F.col(f"m{i}")) / F.lit(least[i]) for i, n in enumerate(names)}
    )
    length = F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(names))), F.lit(0.0)))
    centred = centred.withColumn("length", F.greatest(length, F.lit(1e-9)))

    def products(of) -> Column:
        return _granted([F.avg(of(i) * of(j)) * F.lit(least[i] * least[j]) for i, j in PAIRS])

    medians_of = F.array(*(F.max(f"m{i}") for i in range(len(names))))
    none = _granted([F.lit(0.0)] * len(PAIRS))
    found = centred.groupBy("pool").agg(
        F.count("*").alias("n"),
        F.array(
            F.struct(medians_of.alias("m"), none.alias("c")),
            F.struct(medians_of.alias("m"), products(lambda i: F.col(f"z{i}") / F.col("length")).alias("c")),
            F.struct(medians_of.alias("m"), products(lambda i: F.tanh(f"z{i}")).alias("c")),
            F.struct(
                F.array(*(F.avg(n) for n in names)).alias("m"),
                _granted([F.covar_pop(names[i], names[j]) for i, j in PAIRS]).alias("c"),
            ),
        ).alias("starts"),
    )
    return found.select("pool", "n", F.posexplode("starts").alias("start", "e")).select("pool", "n", "start", "e.m", "e.c")


def _concentrate(points: DataFrame, estimates: DataFrame) -> DataFrame:
    """pool, start, m, c of the share of each pool with the smallest distances by each estimate."""
    names, by = list(STATISTICS), ["pool", "start"]
    binned = _with_distance(points, estimates).withColumn("bin", F.ceil(F.log1p("distance") * DISTANCE_BINS))
    # Written first, so that the join knows its size and no row is shuffled by its pool.
    edge = materialize(_quantile_bin(binned, by, SUBSET).withColumnRenamed("bin", "edge"), "outlier-edges")
    near = binned.join(edge, by).where(F.col("bin") <= F.col("edge"))
    return near.groupBy(*by).agg(
        F.array(*(F.avg(n) for n in names)).alias("m"),
        _granted([F.covar_pop(names[i], names[j]) * F.lit(CONSISTENCY) for i, j in PAIRS]).alias("c"),
    )


def estimates_of(rows: DataFrame, max_steps: int = MAX_STEPS) -> DataFrame:
    """pool, n, start, m, c, logdet: the estimate of least determinant of each pool of `rows`.

    A step's result replaces the one before only if its determinant is less. Pools and starts that
    no longer move are left out of the next step.
    """
    points = rows.select(F.explode("pools").alias("pool"), *STATISTICS)
    first = _factored(_starts(points)).withColumns({"logdet": F.lit(math.inf), "moving": F.lit(True)})
    found = materialize(first, "outlier-start")
    for step in range(1, max_steps + 1):
        taken = _factored(_concentrate(points, found.where("moving"))).withColumnsRenamed(
            {c: f"new_{c}" for c in ("m", "c", "logdet", *_FACTORS)}
        )
        falls = F.coalesce(F.col("new_logdet") < F.col("logdet"), F.lit(False))
        both = found.join(taken, ["pool", "start"], "left").withColumns(
            {"falls": falls, "moving": falls & (F.col("logdet") - F.col("new_logdet") > TOLERANCE)}
        )
        moved = both.select(
            "pool",
            "n",
            "start",
            "moving",
            *(F.when(F.col("falls"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in ("m", "c", "logdet", *_FACTORS)),
        )
        if step == TRIAL_STEPS:
            best = F.row_number().over(Window.partitionBy("pool").orderBy("logdet", "start"))
            moved = moved.withColumn("best", best).where(F.col("best") <= KEPT).drop("best")
        found = materialize(moved, f"outlier-step{step}")
        if step >= TRIAL_STEPS and found.where("moving").isEmpty():
            break
    least = F.min(F.struct("logdet", "start", "m", "c")).alias("e")
    return found.groupBy("pool").agg(F.max("n").alias("n"), least).select("pool", "n", "e.*")


def shrunk(groups: DataFrame, estimates: DataFrame) -> DataFrame:
    """pool, m, c and factor of every group of `groups` (column `pools`), drawn towards the wider ones."""
    chain = groups.select("pools").distinct().select(F.get("pools", F.lit(0)).alias("group"), F.posexplode("pools").alias("level", "pool"))
    at = lambda level, what: F.first(F.when(F.col("level") == level, what), ignorenulls=True)
    wide = (
        chain.join(estimates.select("pool", "n", F.concat("m", "c").alias("v")), "pool", "left")
        .groupBy("group")
        .agg(*(at(k, F.col(c)).alias(f"{c}{k}") for k in range(3) for c in ("n", "v")))
    )

    def drawn(own: str, n: str, wider: Column) -> Column:
        share = F.col(n) / (F.col(n) + F.lit(SHRINK))
        return F.coalesce(F.zip_with(own, wider, lambda a, b: share * a + (F.lit(1.0) - share) * b), wider)

    of_lang = wide.withColumn("lang_v", drawn("v1", "n1", F.col("v2")))
    final = of_lang.withColumn("v", drawn("v0", "n0", F.col("lang_v")))
    size = len(STATISTICS)
    return _factored(
        final.select(
            F.col("group").alias("pool"),
            F.slice("v", 1, size).alias("m"),
            F.slice("v", size + 1, len(PAIRS)).alias("c"),
        )
    )


def measured_rows(stats: DataFrame, passing: DataFrame, max_steps: int = MAX_STEPS) -> DataFrame:
    """Each row of `stats` with `distance` by the drawn estimate of its group among `passing`."""
    by_group = _with_pools(stats)
    estimates = estimates_of(_with_pools(passing), max_steps)
    own = by_group.withColumn("pool", F.get("pools", F.lit(0)))
    found = materialize(shrunk(by_group, estimates), "outlier-estimates")
    return _with_distance(own, found, "left").select(*stats.columns, "distance")


def reject_outliers(docs: DataFrame, cutoff: float = CUTOFF, max_steps: int = MAX_STEPS) -> DataFrame:
    """Base counts, base_failed, distance and kept for documents (doc_id, text, lang, source)."""
    narrow = kept_as(docs, doc_id="doc_id", text="text", lang="lang", source="source")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    stats = materialize(with_vector(with_statistics(narrow)).withColumn("base_failed", failed), "text-statistics")
    passing = stats.where(~F.col("base_failed"))
    both = measured_rows(stats, passing, max_steps)
    inside = F.coalesce(F.col("distance") <= F.lit(cutoff), F.lit(True))
    return both.withColumn("kept", ~F.col("base_failed") & inside)


def chi2_tail(value: float) -> float:
    """P(chi2 with 5 degrees of freedom > value); documents CUTOFF and checks it in tests."""
    root = math.sqrt(value / 2)
    near = math.exp(-value / 2) * math.sqrt(2 * value / math.pi) * (1 + value / 3)
    return math.erfc(root) + near
