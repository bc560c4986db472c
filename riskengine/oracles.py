"""DuckDB statements that compute what each query computes, on the same tables.

They are written for one machine: unpartitioned windows and self joins are fine here.
"""

from __future__ import annotations

from riskengine import queries as q
from riskengine.functions.resampling import GAMMA, MIX, REP_SHIFT, RESERVE, TERMS, stream
from riskengine.operators.bootstrap import KEY_DIGITS, KEY_SCALE, REPORT_PERCENTILES
from riskengine.operators.curves import CANDIDATE_THRESHOLDS
from riskengine.schema import FEATURES, KEY_FEATURES, PCA_FEATURES, RAW_COLUMNS

D = "CAST({} AS DOUBLE)".format
V = ", ".join(PCA_FEATURES)
_V_CAST = ", ".join(f"CAST(m.embedding[{i}] AS DOUBLE) AS V{i}" for i in range(1, 29))

TXN = f"""txn AS (
  SELECT e.event_id AS txn_id, e.ts AS ts,
         CAST(floor(epoch(e.ts)) - 1704067200 AS DOUBLE) AS Time, {_V_CAST},
         e.value AS Amount, CAST(CASE WHEN m.label = 3 THEN 1 ELSE 0 END AS INT) AS Class
  FROM (SELECT e0.*, e0.event_id % c.n AS vkey
        FROM events e0 CROSS JOIN (SELECT count(*) AS n FROM embeddings) c) e
  JOIN embeddings m ON m.vec_id = e.vkey)"""

SCORED = """scored AS (
  SELECT *, ts AS scored_at,
         CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * za / (1 + abs(za)) AS p,
         CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * zb / (1 + abs(zb)) AS p_b,
         CAST(5 + (txn_id % 97) / CAST(10 AS DOUBLE) AS DOUBLE) AS scoring_latency_ms
  FROM (SELECT *, ROUND(10 * (V6 + V21) - 1, 2) AS za, ROUND(10 * V6 - 1, 2) AS zb FROM txn))"""

_ENGINEERED = (
    "ln(1 + Amount) AS log_amount, (Time % CAST(86400 AS DOUBLE)) / 3600 AS hour_of_day"
)
FEATS = f"feats AS (SELECT txn_id, ts, Time, Amount, Class, {V}, {_ENGINEERED} FROM txn)"
RANKED = """ranked AS (
  SELECT *, row_number() OVER (ORDER BY Time, txn_id) AS rn, count(*) OVER () AS n FROM {src})"""
_TRAIN = "rn <= floor(n * CAST(0.8 AS DOUBLE))"
COST = """cost AS (SELECT avg(Amount) FILTER (WHERE Class = 1) AS fn_cost FROM txn)"""

_FEATURE_OUT = f"txn_id, {V}, ROUND(log_amount, 9) AS log_amount, hour_of_day"
_PAYLOAD = f"txn_id, Time, {V}, Amount, Class"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _ranked(src: str) -> str:
    return RANKED.format(src=src)


def _draw(*parts: str, digits: int = 8) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, {digits})) AS UBIGINT)"


def _uniform(*parts: str) -> str:
    return f"(CAST({_draw(*parts)} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)"


def _noise(feature: str, mean: float, std: float) -> str:
    u1, u2 = (_uniform("'42'", f"'{feature}'", "txn_id", f"'{u}'") for u in ("u1", "u2"))
    return (
        f"({D(mean)} + {D(std)} * sqrt({D(-2)} * ln({u1})) * cos(2 * pi() * ({u2})))"
    )


def _ratio(num: str, den: str, default: str = "0") -> str:
    return f"CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE {D(default)} END"


def _unpivot(src: str, cols: list[str]) -> str:
    return f"(UNPIVOT {src} ON {', '.join(cols)} INTO NAME feature VALUE value)"


def _count(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


def _confusion(flag: str) -> str:
    return ", ".join(
        f"{_count(c)} AS {n}"
        for n, c in (
            ("tp", f"{flag} AND Class = 1"),
            ("fp", f"{flag} AND Class = 0"),
            ("fn", f"NOT ({flag}) AND Class = 1"),
            ("tn", f"NOT ({flag}) AND Class = 0"),
        )
    )


_QUALITY = f"{_ratio('tp', 'tp + fp')} AS precision, {_ratio('tp', 'tp + fn')} AS recall"
_COSTS = (
    "CAST(0 AS DOUBLE) AS tp_cost, ROUND(CAST(fp * 10 AS DOUBLE), 6) AS fp_cost, "
    "ROUND(fn * fn_cost, 6) AS fn_cost, CAST(0 AS DOUBLE) AS tn_cost, "
    "ROUND(fp * CAST(10 AS DOUBLE) + fn * fn_cost, 6) AS total_cost"
)

# --- sources -------------------------------------------------------------------------------

_ALL = _with(TXN) + f"SELECT {_PAYLOAD} FROM txn"

ORACLES: dict[str, str] = {
    "csv_scan": _ALL,
    "json_encode": _ALL,
    "raw_zone_ingest": _ALL,
    "raw_zone_compacted": _ALL,
    "stream_replay": _with(TXN, _ranked("txn"))
    + f"""SELECT rn - 1 AS rank, (rn - 1) // ((n + {q.REPLAY_BATCHES} - 1) // {q.REPLAY_BATCHES}) AS batch,
       txn_id, Time, Amount, Class FROM ranked""",
    "replay_slice": _with(TXN, _ranked("txn"))
    + "SELECT txn_id, Time, Amount, Class FROM ranked "
    + f"WHERE rn > {q.REPLAY_START} AND rn <= {q.REPLAY_START + q.REPLAY_LIMIT}",
    "reference_scan": _with(TXN, FEATS, _ranked("feats"))
    + f"SELECT {_FEATURE_OUT} FROM ranked WHERE rn <= {q.REFERENCE_ROWS} "
    + f"ORDER BY {_draw(chr(39) + '42' + chr(39), 'txn_id', digits=13)}, txn_id LIMIT {q.REFERENCE_SAMPLE}",
    "feature_store_roundtrip": _with(TXN, FEATS) + f"SELECT {_FEATURE_OUT}, Class FROM feats",
    "feature_store_versions": _with(TXN, _ranked("txn"))
    + f"""
SELECT CAST(1 AS BIGINT) AS version, 'training rows' AS description, {_count(_TRAIN)} AS n_rows,
       CAST(32 AS BIGINT) AS n_columns, FALSE AS is_current, {_count(_TRAIN)} AS rows_read,
       CAST(sum(Class) FILTER (WHERE {_TRAIN}) AS BIGINT) AS n_fraud
FROM ranked
UNION ALL
SELECT 2, 'all rows', count(*), 32, TRUE, count(*), CAST(sum(Class) AS BIGINT) FROM ranked""",
    "dead_letter_split": _with(TXN)
    + """SELECT txn_id AS key,
  CASE WHEN txn_id % 10 IN (3, 5, 7) THEN 'dead_letter' ELSE 'ok' END AS status,
  CASE txn_id % 10 WHEN 3 THEN 'bad_json' WHEN 5 THEN 'missing:V14' WHEN 7 THEN 'missing:Amount' END
    AS problem
FROM txn""",
    "stream_dead_letters": _with(TXN)
    + """SELECT problem, count(*) AS n FROM (
  SELECT CASE txn_id % 10 WHEN 3 THEN 'bad_json' WHEN 5 THEN 'missing:V14'
              WHEN 7 THEN 'missing:Amount' END AS problem FROM txn)
WHERE problem IS NOT NULL GROUP BY problem""",
    "predictions_sink": _with(TXN, SCORED, _ranked("scored"))
    + f"SELECT txn_id, Class AS y_true, p, p_b FROM ranked WHERE NOT ({_TRAIN})",
}

# --- projections and quality ---------------------------------------------------------------

_AUDIT = {c: f"count(*) FILTER (WHERE {c} IS NULL)" for c in ["txn_id", *RAW_COLUMNS, "Class"]}
_AUDIT["Amount"] = _count("txn_id % 23 = 0")
_AUDIT["V14"] = _count("txn_id % 17 = 0")

ORACLES |= {
    "compute_features": _with(TXN, FEATS) + f"SELECT {_FEATURE_OUT} FROM feats",
    "feature_matrix": _with(TXN, FEATS) + f"SELECT {_FEATURE_OUT}, Class FROM feats",
    "prepare_features": _with(TXN, FEATS)
    + f"SELECT {_PAYLOAD}, ROUND(log_amount, 9) AS log_amount, hour_of_day FROM feats",
    "amount_log": _with(TXN, FEATS)
    + "SELECT txn_id, Amount, ROUND(log_amount, 9) AS log_amount FROM feats",
    "hour_of_day": _with(TXN, FEATS) + "SELECT txn_id, Time, hour_of_day FROM feats",
    "null_audit": _with(TXN)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({e} AS BIGINT) AS n_missing FROM txn"
        for c, e in _AUDIT.items()
    ),
    "inf_audit": _with(TXN)
    + f"""SELECT count(*) AS n_rows, {_count('txn_id % 29 = 0')} AS n_inf,
  {_count('txn_id % 29 <> 0 AND txn_id % 31 = 0')} AS n_nan FROM txn""",
    "prescale_check": _with(TXN)
    + f"""SELECT feature, ROUND(avg(value), 9) AS mean, ROUND(stddev_samp(value), 9) AS std
FROM {_unpivot('txn', PCA_FEATURES)} GROUP BY feature""",
    "synthetic_drift": _with(TXN, FEATS)
    + "SELECT txn_id, ROUND(log_amount + 2, 9) AS log_amount, "
    + ", ".join(f"ROUND({f} + {_noise(f, 1.5, 1.0)}, 9) AS {f}" for f in KEY_FEATURES)
    + " FROM feats",
}

# --- splits --------------------------------------------------------------------------------

_EFFECTS = f"""effects AS (
  SELECT feature, fraud_mean, legit_mean, fraud_mean - legit_mean AS mean_diff,
         (fraud_mean - legit_mean) / legit_std AS effect_size, fraud_std, legit_std
  FROM (SELECT feature, avg(value) FILTER (WHERE Class = 1) AS fraud_mean,
               avg(value) FILTER (WHERE Class = 0) AS legit_mean,
               stddev_samp(value) FILTER (WHERE Class = 1) AS fraud_std,
               stddev_samp(value) FILTER (WHERE Class = 0) AS legit_std
        FROM {_unpivot('txn', RAW_COLUMNS)} GROUP BY feature))"""
_EFFECT_OUT = "SELECT feature, " + ", ".join(
    f"ROUND({c}, 6) AS {c}"
    for c in ("fraud_mean", "legit_mean", "mean_diff", "effect_size", "fraud_std", "legit_std")
)

ORACLES |= {
    "time_split": _with(TXN, _ranked("txn"))
    + f"SELECT txn_id, Time, Class, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS split FROM ranked",
    "split_stats": _with(TXN, _ranked("txn"))
    + f"""SELECT split, n_rows, n_legit, n_fraud, time_min, time_max,
  ROUND(CAST(n_fraud AS DOUBLE) / n_rows * 100, 9) AS fraud_pct,
  ROUND({_ratio('n_legit', 'n_fraud')}, 9) AS legit_per_fraud,
  split = 'test' AND n_fraud < 80 AS low_fraud_warning
FROM (SELECT CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows,
        {_count('Class = 0')} AS n_legit, {_count('Class = 1')} AS n_fraud,
        min(Time) AS time_min, max(Time) AS time_max FROM ranked GROUP BY 1)""",
    "sample_n": _with(TXN)
    + f"""SELECT txn_id, Time, Amount, Class FROM txn
ORDER BY {_draw("'42'", 'txn_id', digits=13)}, txn_id LIMIT {q.SAMPLE_ROWS}""",
    "top_effects": _with(TXN, _EFFECTS)
    + f"{_EFFECT_OUT} FROM effects ORDER BY abs(effects.effect_size) DESC, feature LIMIT 10",
    "weakest_effects": _with(TXN, _EFFECTS)
    + f"{_EFFECT_OUT} FROM effects ORDER BY abs(effects.effect_size), feature LIMIT 5",
    "class_effect_size": _with(TXN, _EFFECTS) + f"{_EFFECT_OUT} FROM effects",
}

# --- profiling -----------------------------------------------------------------------------

_NULLS = " + ".join(f"count(*) - count({c})" for c in [*RAW_COLUMNS, "Class"])
_TYPES = {**{c: "double" for c in RAW_COLUMNS}, "Class": "int"}
_QUANTILES = {"median": 0.5, "p1": 0.01, "p5": 0.05, "p25": 0.25, "p75": 0.75, "p95": 0.95, "p99": 0.99}
_BALANCE = f"""bal AS (SELECT {_count('Class = 1')} AS n_fraud, {_count('Class = 0')} AS n_legit,
  count(*) AS n_total FROM {{src}})"""


def _profile(rows: str) -> str:
    return (
        _with(
            TXN,
            f"side AS (SELECT * FROM txn WHERE {rows})",
            f"long AS (SELECT feature, value FROM {_unpivot('side', RAW_COLUMNS)})",
            """m AS (SELECT feature, avg(value) AS mu, CAST(count(*) AS DOUBLE) AS n FROM long GROUP BY feature)""",
            """c AS (SELECT feature, any_value(n) AS n, avg((value - mu) ** 2) AS m2,
              avg((value - mu) ** 3) AS m3, avg((value - mu) ** 4) AS m4
              FROM long JOIN m USING (feature) GROUP BY feature)""",
            """s AS (SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
              max(value) AS max, """
            + ", ".join(f"quantile_cont(value, {v}) AS {k}" for k, v in _QUANTILES.items())
            + " FROM long GROUP BY feature)",
        )
        + "SELECT feature, "
        + ", ".join(f"ROUND({k}, 6) AS {k}" for k in ("mean", "std", "median", "min", "max", "p1", "p5", "p25", "p75", "p95", "p99"))
        + """, ROUND(m3 / m2 ** 1.5 * sqrt(n * (n - 1)) / (n - 2), 6) AS skewness,
      ROUND((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / m2 ** 2 - 3) + 6), 6) AS kurtosis
    FROM s JOIN c USING (feature)"""
    )


ORACLES |= {
    "dataset_summary": _with(TXN)
    + f"""SELECT n_rows, CAST(31 AS BIGINT) AS n_cols, n_fraud, n_legit,
  CAST(n_fraud AS DOUBLE) / n_rows AS fraud_rate,
  CAST(n_fraud AS DOUBLE) / n_rows * 100 AS fraud_rate_pct, n_missing
FROM (SELECT count(*) AS n_rows, {_count('Class = 1')} AS n_fraud, {_count('Class = 0')} AS n_legit,
        CAST({_NULLS} AS BIGINT) AS n_missing FROM txn)""",
    "dataset_columns": _with(TXN)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({i} AS BIGINT) AS position, '{t}' AS dtype, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS n_missing FROM txn"
        for i, (c, t) in enumerate(_TYPES.items(), 1)
    ),
    "statistical_profile": _profile("true"),
    "class_profiles": f"SELECT 1 AS Class, * FROM ({_profile('Class = 1')}) UNION ALL "
    + f"SELECT 0, * FROM ({_profile('Class = 0')})",
    "amount_outliers": _with(
        TXN,
        """qs AS (SELECT quantile_cont(Amount, 0.25) AS q1, quantile_cont(Amount, 0.75) AS q3,
          quantile_cont(Amount, 0.99) AS p99, quantile_cont(Amount, 0.999) AS p999 FROM txn)""",
        """f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence,
          q3 + 1.5 * (q3 - q1) AS upper_fence FROM qs)""",
    )
    + "SELECT "
    + ", ".join(
        f"ROUND(any_value({c}), 9) AS {c}"
        for c in ("q1", "q3", "iqr", "lower_fence", "upper_fence", "p99", "p999")
    )
    + f""", ROUND(max(Amount), 9) AS max_amount, {_count('Amount > upper_fence')} AS n_outlier_iqr,
  {_count('Amount > p99')} AS n_extreme_p99,
  ROUND(coalesce(avg(Class) FILTER (WHERE Amount > upper_fence), 0), 9) AS fraud_rate_outlier_iqr,
  ROUND(coalesce(avg(Class) FILTER (WHERE NOT Amount > upper_fence), 0), 9) AS fraud_rate_normal,
  ROUND(coalesce(avg(Class) FILTER (WHERE Amount > p99), 0), 9) AS fraud_rate_extreme_p99,
  ROUND(avg(Class), 9) AS overall_fraud_rate, """
    + ", ".join(
        f"ROUND({e} FILTER (WHERE Class = {y}), 9) AS {who}_amount_{k}"
        for who, y in (("fraud", 1), ("legit", 0))
        for k, e in (
            ("mean", "avg(Amount)"),
            ("median", "median(Amount)"),
            ("max", "max(Amount)"),
            ("std", "stddev_samp(Amount)"),
        )
    )
    + " FROM txn CROSS JOIN f",
    "imbalance": _with(TXN, _BALANCE.format(src="txn"))
    + f"""SELECT n_fraud, n_legit, n_total, CAST(n_fraud AS DOUBLE) / n_total AS fraud_rate,
  CAST(n_fraud AS DOUBLE) / n_total * 100 AS fraud_rate_pct,
  {_ratio('n_legit', 'n_fraud', "'inf'")} AS imbalance_ratio,
  {_ratio('n_legit', 'n_fraud', '1')} AS scale_pos_weight FROM bal""",
    "naive_baseline": _with(TXN, _BALANCE.format(src="txn"))
    + """SELECT CAST(n_legit AS DOUBLE) / n_total AS accuracy,
  CAST(n_legit AS DOUBLE) / n_total * 100 AS accuracy_pct, n_legit AS n_correct, n_fraud AS n_wrong
FROM bal""",
    "scale_pos_weight": _with(
        TXN, _ranked("txn"), f"train AS (SELECT * FROM ranked WHERE {_TRAIN})", _BALANCE.format(src="train")
    )
    + f"SELECT n_legit, n_fraud, {_ratio('n_legit', 'n_fraud', '1')} AS scale_pos_weight FROM bal",
    "cost_calibration": _with(TXN, COST)
    + """SELECT ROUND(fn_cost, 9) AS fn_cost, CAST(10 AS DOUBLE) AS fp_cost, CAST(0 AS DOUBLE) AS tp_cost,
  CAST(0 AS DOUBLE) AS tn_cost, ROUND(fn_cost, 9) AS avg_fraud_amount, ROUND(fn_cost / 10, 9) AS cost_ratio
FROM cost""",
    "expected_cost": _with(TXN, SCORED, COST)
    + f"""SELECT day, tp, fp, fn, tn, {_COSTS} FROM (
  SELECT strftime(scored_at, '%Y-%m-%d') AS day, {_confusion(f'p >= {q.THRESHOLD}')}
  FROM scored GROUP BY 1) CROSS JOIN cost""",
    "cost_scenario": _with(TXN, COST, _BALANCE.format(src="txn"))
    + f"""SELECT tp, fp, n_fraud - tp AS fn, n_legit - fp AS tn, CAST(0 AS DOUBLE) AS tp_cost,
  fp * CAST(10 AS DOUBLE) AS fp_cost, ROUND((n_fraud - tp) * fn_cost, 6) AS fn_cost,
  CAST(0 AS DOUBLE) AS tn_cost, ROUND(fp * CAST(10 AS DOUBLE) + (n_fraud - tp) * fn_cost, 6) AS total_cost
FROM (SELECT *, CAST(floor(n_fraud * {D(0.8)}) AS BIGINT) AS tp,
        CAST(floor(n_legit * {D(0.02)}) AS BIGINT) AS fp FROM bal) CROSS JOIN cost""",
}

# --- evaluation ----------------------------------------------------------------------------

_CURVE = """g AS (SELECT p, CAST(sum(Class) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n
      FROM scored GROUP BY p),
c AS (SELECT p, pos, n - pos AS neg,
        sum(pos) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS tp,
        sum(n) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cn FROM g)"""
_AUC = "CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(pos + neg) AS BIGINT) AS n_rows"
_SWEEP = f"""th AS (SELECT i, i * {D(0.001)} AS threshold FROM range(0, 1001) t(i)),
cells AS (SELECT p, Class, count(*) AS k FROM scored GROUP BY p, Class),
sweep AS (SELECT i, threshold,
    CAST(coalesce(sum(k) FILTER (WHERE p >= threshold AND Class = 1), 0) AS BIGINT) AS tp,
    CAST(coalesce(sum(k) FILTER (WHERE p >= threshold AND Class = 0), 0) AS BIGINT) AS fp,
    CAST(coalesce(sum(k) FILTER (WHERE NOT p >= threshold AND Class = 1), 0) AS BIGINT) AS fn,
    CAST(coalesce(sum(k) FILTER (WHERE NOT p >= threshold AND Class = 0), 0) AS BIGINT) AS tn
  FROM th CROSS JOIN cells GROUP BY i, threshold),
priced AS (SELECT *, fp * CAST(10 AS DOUBLE) + fn * fn_cost AS total_cost FROM sweep CROSS JOIN cost),
best AS (SELECT * FROM priced ORDER BY total_cost, i LIMIT 1)"""


def _at(thresholds: tuple[float, ...]) -> str:
    values = ", ".join(f"({D(t)})" for t in thresholds)
    return _with(
        TXN,
        SCORED,
        COST,
        f"t AS (SELECT * FROM (VALUES {values}) v(threshold))",
        f"conf AS (SELECT threshold, {_confusion('p >= threshold')} FROM scored CROSS JOIN t GROUP BY threshold)",
        f"qual AS (SELECT *, {_QUALITY} FROM conf)",
    ) + f"""SELECT threshold, tp, fp, fn, tn, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall,
  ROUND({_ratio('2 * precision * recall', 'precision + recall')}, 6) AS f1, {_COSTS}
FROM qual CROSS JOIN cost"""


def _bands(col: str, src: str, bands, ctes: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {col} >= {lo} AND {col} < {hi} THEN '{n}'" for lo, hi, n in bands)
    return _with(*ctes) + f"""SELECT *, {_QUALITY} FROM (
  SELECT CASE {cases} END AS band, count(*) AS n_total, {_count('Class = 1')} AS n_fraud,
         {_confusion(f'p >= {q.THRESHOLD}')}
  FROM {src} GROUP BY 1) WHERE band IS NOT NULL"""


_AMOUNT_BANDS = [(0, 10, "$0-10"), (10, 50, "$10-50"), (50, 200, "$50-200"), (200, 1000, "$200-1K"),
                 (1000, "CAST('inf' AS DOUBLE)", "$1K+")]
_HOUR_BANDS = [(0, 6, "00:00-06:00"), (6, 12, "06:00-12:00"), (12, 18, "12:00-18:00"), (18, 24, "18:00-24:00")]
_HOURLY = f"hourly AS (SELECT *, (Time % {D(86400)}) / 3600 AS hour_of_day FROM scored)"


def _ap(score: str) -> str:
    return f"""ap_{score} AS (
  SELECT rep, sum(pos * tp / cn) / sum(pos) AS auc FROM (
    SELECT rep, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS cn
    FROM (SELECT rep, {score} AS s, CAST(sum(y * w) AS DOUBLE) AS pos, CAST(sum(w) AS DOUBLE) AS n
          FROM drawn WHERE w > 0 GROUP BY rep, {score})
    WINDOW w AS (PARTITION BY rep ORDER BY s DESC ROWS UNBOUNDED PRECEDING))
  GROUP BY rep)"""


def _spelled(score: str) -> str:
    parts, left = [], score
    for _ in range(3):
        parts.append(f"CAST(floor({left}) AS BIGINT)")
        left = f"(({left} - floor({left})) * {D(int(KEY_SCALE))})"
    return ", ".join(parts)




def _wrap(left: str, right: int) -> str:
    return f"CAST((CAST({left} AS UHUGEINT) * CAST({right} AS UHUGEINT)) % CAST({2**64} AS UHUGEINT) AS UBIGINT)"


def _numbers(src: str, counter: str, purpose: int) -> str:
    """The query `src` with `u`, the uniform number of its rep and counter."""
    start, at = stream(42, purpose, 0), f"(CAST(rep AS UBIGINT) * {2**REP_SHIFT} + CAST({counter} AS UBIGINT))"
    first = f"CAST((CAST({_wrap(at, GAMMA)} AS UHUGEINT) + CAST({start} AS UHUGEINT)) % CAST({2**64} AS UHUGEINT) AS UBIGINT)"
    return f"""(SELECT * EXCLUDE (z, z1, z2), CAST(xor(z2, z2 >> 31) >> 11 AS DOUBLE) / CAST({2**53} AS DOUBLE) AS u
      FROM (SELECT *, {_wrap("xor(z1, z1 >> 27)", MIX[1])} AS z2
      FROM (SELECT *, {_wrap("xor(z, z >> 30)", MIX[0])} AS z1 FROM (SELECT *, {first} AS z FROM {src}))))"""


_BOOT = _with(
    TXN,
    SCORED,
    _ranked("scored"),
    f"""held AS (SELECT p, p_b, Class AS y, concat_ws(':', {_spelled("p")}, {_spelled("p_b")}, Class) AS cell
      FROM ranked WHERE NOT ({_TRAIN}))""",
    f"""placed AS (SELECT p, p_b, y,
      row_number() OVER (ORDER BY {_draw(chr(39) + "42" + chr(39), "cell", digits=KEY_DIGITS)}, p, p_b, y) - 1 AS place FROM held)""",
    f"""size AS (SELECT n, greatest(0, 1 - {D(RESERVE)} / sqrt(CAST(n AS DOUBLE))) AS lam FROM (SELECT count(*) AS n FROM held))""",
    f"""cdf AS (SELECT n, list_transform(range(1, {TERMS + 1}), lambda k: list_sum(terms[1:k])) AS cdf
      FROM (SELECT n, list_transform(range({TERMS}), lambda k: exp(-lam) * pow(lam, k) / factorial(CAST(k AS INT))) AS terms FROM size))""",
    f"""weighed AS (SELECT rep, place, n, len(list_filter(cdf, lambda c: c < u)) AS w
      FROM {_numbers(f"(SELECT * FROM placed CROSS JOIN cdf CROSS JOIN range(0, {q.N_BOOTSTRAPS}) r(rep))", "place", 0)})""",
    f"""late AS (SELECT rep, CAST(floor(u * n) AS BIGINT) AS place, count(*) AS w
      FROM {_numbers("(SELECT rep, n, unnest(range(CAST(n - sum(w) AS BIGINT))) AS k FROM weighed GROUP BY rep, n)", "k", 1)}
      GROUP BY ALL)""",
    """drawn AS (SELECT rep, p, p_b, y, sum(w) AS w
      FROM (SELECT rep, place, w FROM weighed UNION ALL SELECT * FROM late) JOIN placed USING (place) GROUP BY ALL)""",
    _ap("p"),
    _ap("p_b"),
    """samples AS (SELECT rep + 1 AS iteration, a.auc AS auc_pr_a, b.auc AS auc_pr_b,
      a.auc - b.auc AS diff FROM ap_p a JOIN ap_p_b b USING (rep))""",
)
_SUMMARY = (
    "summary AS (SELECT count(*) AS n_bootstraps, "
    + ", ".join(
        f"{e} AS {name}_{k}"
        for name, col in (("a", "auc_pr_a"), ("b", "auc_pr_b"), ("diff", "diff"))
        for k, e in (
            ("mean", f"avg({col})"),
            ("std", f"stddev_pop({col})"),
            ("median", f"quantile_cont({col}, 0.5)"),
            ("ci_lower", f"quantile_cont({col}, 0.025)"),
            ("ci_upper", f"quantile_cont({col}, 0.975)"),
            ("q25", f"quantile_cont({col}, 0.25)"),
            ("q75", f"quantile_cont({col}, 0.75)"),
        )
    )
    + ", "
    + ", ".join(
        f"avg(CASE WHEN diff {op} 0 THEN CAST(1 AS DOUBLE) ELSE 0 END) AS {n}"
        for n, op in (("prob_a_superior", ">"), ("prob_b_superior", "<"), ("prob_tie", "="))
    )
    + " FROM samples)"
)
_SIGNIFICANT = "((diff_ci_lower > 0 AND diff_ci_upper > 0) OR (diff_ci_lower < 0 AND diff_ci_upper < 0))"
_SUMMARY_COLS = [
    f"{n}_{k}"
    for n in ("a", "b", "diff")
    for k in ("mean", "std", "median", "ci_lower", "ci_upper", "q25", "q75")
] + ["prob_a_superior", "prob_b_superior", "prob_tie"]

ORACLES |= {
    "auc_pr": _with(TXN, SCORED, _CURVE)
    + f"SELECT {_AUC}, ROUND(sum(pos * tp / cn) / sum(pos), 9) AS auc_pr FROM c",
    "auc_roc": _with(TXN, SCORED, _CURVE)
    + f"""SELECT {_AUC}, ROUND(sum(neg * (tp - pos) + CAST(0.5 AS DOUBLE) * pos * neg)
  / (sum(pos) * sum(neg)), 9) AS auc_roc FROM c""",
    "threshold_sweep": _with(TXN, SCORED, COST, _SWEEP)
    + "SELECT i, threshold, tp, fp, fn, tn, ROUND(total_cost, 6) AS total_cost FROM priced",
    "optimal_threshold": _with(TXN, SCORED, COST, _SWEEP)
    + f"""SELECT threshold AS optimal_threshold, ROUND(total_cost, 6) AS min_cost, tp, fp, fn, tn, {_QUALITY},
  ROUND((SELECT total_cost FROM priced WHERE i = 500), 6) AS cost_at_default FROM best""",
    "confusion_at": _at((q.THRESHOLD,)),
    "candidate_thresholds": _at(CANDIDATE_THRESHOLDS),
    "slice_by_amount": _bands("Amount", "scored", _AMOUNT_BANDS, (TXN, SCORED)),
    "slice_by_hour": _bands("hour_of_day", "hourly", _HOUR_BANDS, (TXN, SCORED, _HOURLY)),
    "bootstrap_samples": _BOOT
    + """SELECT iteration, ROUND(auc_pr_a, 9) AS auc_pr_a, ROUND(auc_pr_b, 9) AS auc_pr_b,
  ROUND(diff, 9) AS diff FROM samples""",
    "bootstrap_summary": _BOOT.rstrip() + ",\n" + _SUMMARY
    + "\nSELECT n_bootstraps, "
    + ", ".join(f"ROUND({c}, 9) AS {c}" for c in _SUMMARY_COLS)
    + f", {_SIGNIFICANT} AS significant FROM summary",
    "bootstrap_percentiles": _BOOT
    + " UNION ALL ".join(
        f"SELECT {D(p)} AS percentile, "
        + ", ".join(
            f"ROUND(quantile_cont({c}, {p / 100}), 9) AS {c}" for c in ("auc_pr_a", "auc_pr_b", "diff")
        )
        + " FROM samples"
        for p in REPORT_PERCENTILES
    ),
    "model_choice": _BOOT.rstrip() + ",\n" + _SUMMARY
    + f"""
SELECT CASE WHEN {_SIGNIFICANT} AND diff_ci_lower < 0 THEN 'ensemble' ELSE 'baseline' END AS chosen,
  CASE WHEN NOT {_SIGNIFICANT} THEN 'indistinguishable' WHEN diff_ci_lower > 0 THEN 'a_superior'
       ELSE 'b_superior' END AS reason, {_SIGNIFICANT} AS significant FROM summary""",
}

_SCORE_OUT = """ROUND(p, 6) AS fraud_probability, p >= threshold AS is_fraud, threshold AS threshold_used,
  ROUND(scoring_latency_ms, 3) AS scoring_latency_ms"""
ORACLES["batch_score"] = _with(TXN, SCORED, COST, _SWEEP) + f"""SELECT txn_id, Time, {V}, Amount, {_SCORE_OUT}
FROM scored CROSS JOIN (SELECT threshold FROM best)"""
ORACLES["stream_score"] = ORACLES["batch_score"]
ORACLES["stream_fan_out"] = _with(TXN, SCORED) + f"""SELECT
  CASE WHEN txn_id % 10 <> 3 THEN txn_id END AS txn_id,
  CASE WHEN txn_id % 10 NOT IN (3, 5, 7) THEN ROUND(p, 6) END AS fraud_probability,
  CASE WHEN txn_id % 10 NOT IN (3, 5, 7) THEN p >= {q.THRESHOLD} END AS is_fraud,
  CASE txn_id % 10 WHEN 3 THEN 'bad_json' WHEN 5 THEN 'missing:V14' WHEN 7 THEN 'missing:Amount' END
    AS problem
FROM scored"""

# --- drift ---------------------------------------------------------------------------------

_SIDES = f"""sides AS (
  SELECT feature, value, CASE WHEN {_TRAIN} THEN 1 ELSE 0 END AS a,
         CASE WHEN {_TRAIN} THEN 0 ELSE 1 END AS b
  FROM {{src}})"""


def _distance(keys: str = "") -> str:
    """CTEs from `sides` to `dist` and, from there, to the p-value in `pv`."""
    part = f"PARTITION BY {keys}feature"
    return f"""dg AS (SELECT {keys}feature, value, sum(a) AS a, sum(b) AS b FROM sides GROUP BY {keys}feature, value),
dc AS (SELECT {keys}feature, value, lead(value) OVER ({part} ORDER BY value) AS nx,
    CAST(sum(a) OVER ({part} ORDER BY value ROWS UNBOUNDED PRECEDING) AS DOUBLE)
      / CAST(sum(a) OVER ({part}) AS DOUBLE) AS fa,
    CAST(sum(b) OVER ({part} ORDER BY value ROWS UNBOUNDED PRECEDING) AS DOUBLE)
      / CAST(sum(b) OVER ({part}) AS DOUBLE) AS fb, a, b FROM dg),
dist AS (SELECT {keys}feature, CAST(sum(a) AS BIGINT) AS n_ref, CAST(sum(b) AS BIGINT) AS n_cur,
    max(abs(fa - fb)) AS ks, coalesce(sum(abs(fa - fb) * (nx - value)), 0) AS wasserstein
  FROM dc GROUP BY {keys}feature),
lam AS (SELECT *, ks * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) AS l FROM dist),
pv AS (SELECT *, p_value < CAST(0.05 AS DOUBLE) AS drifted FROM (
  SELECT *, CASE WHEN l < CAST(0.3 AS DOUBLE) THEN CAST(1 AS DOUBLE) ELSE greatest(0, least(1,
    list_sum([CASE WHEN k % 2 = 1 THEN CAST(2 AS DOUBLE) ELSE CAST(-2 AS DOUBLE) END
              * exp(CAST(-2 AS DOUBLE) * k * k * l * l) for k in range(1, 101)]))) END AS p_value
  FROM lam))"""


_LONG = f"flong AS (SELECT feature, value, rn, n FROM {_unpivot('ranked', FEATURES)})"
_DRIFT = (TXN, FEATS, _ranked("feats"), _LONG, _SIDES.format(src="flong"), _distance())
_ORDER = "list_position([" + ", ".join(f"'{f}'" for f in FEATURES) + "], feature)"
_KEY_ORDER = "list_position([" + ", ".join(f"'{f}'" for f in KEY_FEATURES) + "], feature)"
_IS_KEY = "feature IN (" + ", ".join(f"'{f}'" for f in KEY_FEATURES) + ")"


def _decision(keys: str = "") -> str:
    group = f" GROUP BY {keys.rstrip(', ')}" if keys else ""
    return f"""decided AS (SELECT *, CAST(drifted_features_count AS DOUBLE) / total_features_count AS drift_share,
  CAST(drifted_features_count AS DOUBLE) / total_features_count >= {D(0.2)} AS drift_by_share,
  n_key >= 2 AS drift_by_key_features,
  CAST(drifted_features_count AS DOUBLE) / total_features_count >= {D(0.2)} OR n_key >= 2 AS drift_detected
FROM (SELECT {keys}{_count('drifted')} AS drifted_features_count, count(*) AS total_features_count,
    coalesce(string_agg(feature, ',' ORDER BY {_ORDER}) FILTER (WHERE drifted), '') AS drifted_features,
    coalesce(string_agg(feature, ',' ORDER BY {_KEY_ORDER}) FILTER (WHERE drifted AND {_IS_KEY}), '')
      AS key_features_drifted, count(*) FILTER (WHERE drifted AND {_IS_KEY}) AS n_key
  FROM pv{group}))"""


_DECISION_OUT = """drifted_features_count, total_features_count, drifted_features, key_features_drifted,
  ROUND(drift_share, 9) AS drift_share, drift_by_share, drift_by_key_features, drift_detected"""
_MOVED_COLS = ", ".join(
    f"CASE WHEN {_TRAIN} THEN {f} ELSE {f} + {_noise(f, 1.5, 1.0)} END AS {f}"
    if f in KEY_FEATURES
    else f"CASE WHEN {_TRAIN} THEN log_amount ELSE log_amount + 2 END AS log_amount"
    if f == "log_amount"
    else f
    for f in FEATURES
)
_MOVED = (
    TXN,
    FEATS,
    _ranked("feats"),
    f"moved AS (SELECT rn, n, {_MOVED_COLS} FROM ranked)",
    f"mlong AS (SELECT feature, value, rn, n FROM {_unpivot('moved', FEATURES)})",
    _SIDES.format(src="mlong"),
    _distance(),
    _decision(),
)
_WINDOWS = (
    TXN,
    FEATS,
    _ranked("feats"),
    f"ref AS (SELECT * FROM ranked WHERE {_TRAIN})",
    "wins AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS window_start FROM ranked)",
    f"""sides AS (
      SELECT window_start, feature, value, 1 AS a, 0 AS b
      FROM {_unpivot('ref', FEATURES)} CROSS JOIN wins
      UNION ALL
      SELECT strftime(ts, '%Y-%m-%d'), feature, value, 0, 1 FROM {_unpivot('ranked', FEATURES)})""",
    _distance("window_start, "),
)
_WINDOW_MOMENTS = """mom AS (SELECT window_start, feature,
  avg(value) FILTER (WHERE a = 1) AS ref_mean, avg(value) FILTER (WHERE b = 1) AS cur_mean,
  stddev_pop(value) FILTER (WHERE a = 1) AS ref_std, stddev_pop(value) FILTER (WHERE b = 1) AS cur_std
  FROM sides GROUP BY window_start, feature)"""

ORACLES |= {
    "drift_ks": _with(*_DRIFT) + "SELECT feature, n_ref, n_cur, ROUND(ks, 9) AS ks FROM dist",
    "drift_pvalue": _with(*_DRIFT)
    + "SELECT feature, ROUND(p_value, 6) AS p_value, drifted FROM pv",
    "drift_wasserstein": _with(*_DRIFT)
    + "SELECT feature, ROUND(wasserstein, 9) AS wasserstein FROM dist",
    "drift_moments": _with(*_DRIFT)
    + """SELECT feature, ROUND(avg(value) FILTER (WHERE a = 1), 6) AS ref_mean,
  ROUND(avg(value) FILTER (WHERE b = 1), 6) AS cur_mean,
  ROUND(stddev_pop(value) FILTER (WHERE a = 1), 6) AS ref_std,
  ROUND(stddev_pop(value) FILTER (WHERE b = 1), 6) AS cur_std FROM sides GROUP BY feature""",
    "drift_decision": _with(*_MOVED) + f"SELECT {_DECISION_OUT} FROM decided",
    "drift_by_window": _with(*_WINDOWS, _WINDOW_MOMENTS)
    + "SELECT window_start, feature, n_ref, n_cur, "
    + ", ".join(
        f"ROUND({c}, 6) AS {c}"
        for c in ("ks", "wasserstein", "p_value", "ref_mean", "cur_mean", "ref_std", "cur_std")
    )
    + ", drifted FROM pv JOIN mom USING (window_start, feature)",
    "drift_decision_by_window": _with(*_WINDOWS, _decision("window_start, "))
    + f"SELECT window_start, {_DECISION_OUT} FROM decided",
    "retrain_decision": _with(*_WINDOWS, _decision("window_start, "))
    + """SELECT window_start, drift_detected, dayofweek(CAST(window_start AS DATE)) = 0 AS is_scheduled,
  CASE WHEN drift_detected OR dayofweek(CAST(window_start AS DATE)) = 0 THEN 'retrain_model_task'
       ELSE 'skip_retrain_task' END AS branch FROM decided""",
}

# --- governance ----------------------------------------------------------------------------

_GATE = """WITH RECURSIVE runs AS (
  SELECT CAST(o_custkey AS VARCHAR) AS model_name, o_orderkey AS version,
         o_totalprice / CAST(500000 AS DOUBLE) AS auc_pr,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
gate AS (
  SELECT model_name, rn, version, auc_pr, TRUE AS promoted, CAST(NULL AS BIGINT) AS pv,
         CAST(NULL AS DOUBLE) AS pa, version AS sv, auc_pr AS sa FROM runs WHERE rn = 1
  UNION ALL
  SELECT r.model_name, r.rn, r.version, r.auc_pr, r.auc_pr > g.sa + CAST(0.0001 AS DOUBLE), g.sv, g.sa,
         CASE WHEN r.auc_pr > g.sa + CAST(0.0001 AS DOUBLE) THEN r.version ELSE g.sv END,
         CASE WHEN r.auc_pr > g.sa + CAST(0.0001 AS DOUBLE) THEN r.auc_pr ELSE g.sa END
  FROM gate g JOIN runs r ON r.model_name = g.model_name AND r.rn = g.rn + 1)
"""
ORACLES |= {
    "promotion_gate": _GATE
    + """SELECT model_name, version, auc_pr, CASE WHEN promoted THEN 'promoted' ELSE 'rejected' END AS action,
  CASE WHEN rn = 1 THEN 'initial_deployment' WHEN promoted THEN 'strictly_superior'
       ELSE 'not_strictly_superior' END AS reason,
  pv AS previous_version, pa AS previous_auc_pr FROM gate""",
    "registry_stages": _GATE
    + """SELECT model_name, version, auc_pr,
  CASE WHEN version = max(version) FILTER (WHERE promoted) OVER (PARTITION BY model_name) THEN 'Production'
       WHEN promoted THEN 'Archived' ELSE 'Staging' END AS stage FROM gate""",
    "register_versions": """WITH w AS (
  SELECT CAST(o_custkey AS VARCHAR) AS model_name, o_orderkey AS run_id,
         o_totalprice / CAST(500000 AS DOUBLE) AS auc_pr,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS wave FROM orders)
SELECT model_name, run_id, row_number() OVER (PARTITION BY model_name ORDER BY wave, run_id) AS version,
       'Staging' AS stage, auc_pr AS tag_auc_pr, wave FROM w""",
}

# --- streaming and serving -----------------------------------------------------------------

_STATS = """SELECT count(*) AS total_scored, CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS total_flagged,
  ROUND(avg(CASE WHEN is_fraud THEN CAST(1 AS DOUBLE) ELSE 0 END), 9) AS flag_rate,
  ROUND(avg(l), 9) AS latency_mean, ROUND(min(l), 9) AS latency_min, ROUND(max(l), 9) AS latency_max,
  ROUND(quantile_cont(l, 0.5), 9) AS latency_p50, ROUND(quantile_cont(l, 0.95), 9) AS latency_p95,
  ROUND(quantile_cont(l, 0.99), 9) AS latency_p99
FROM (SELECT p >= 0.5 AS is_fraud, ROUND(scoring_latency_ms, 3) AS l FROM scored)"""
_RECENT = f"""SELECT txn_id, Time, ROUND(p, 6) AS fraud_probability, p >= 0.5 AS is_fraud FROM scored
ORDER BY scored_at DESC, txn_id DESC LIMIT {q.RECENT}"""
_FLAGSHIP_CASES = " ".join(f"WHEN Amount >= {lo} AND Amount < {hi} THEN '{n}'" for lo, hi, n in _AMOUNT_BANDS)

ORACLES |= {
    "scoring_stats": _with(TXN, SCORED) + _STATS,
    "stream_scoring_stats": _with(TXN, SCORED) + _STATS,
    "recent_n": _with(TXN, SCORED) + _RECENT,
    "stream_recent": _with(TXN, SCORED) + _RECENT,
    "flagship": _with(TXN, SCORED, COST, _ranked("scored"))
    + f"""SELECT band, n_total, n_fraud, tp, fp, fn, tn, ROUND(precision, 6) AS precision,
  ROUND(recall, 6) AS recall, {_COSTS} FROM (
  SELECT *, {_QUALITY} FROM (
    SELECT CASE {_FLAGSHIP_CASES} END AS band, count(*) AS n_total, {_count('Class = 1')} AS n_fraud,
           {_confusion(f'p >= {q.THRESHOLD}')}
    FROM ranked WHERE NOT ({_TRAIN}) GROUP BY 1) WHERE band IS NOT NULL) CROSS JOIN cost""",
}
