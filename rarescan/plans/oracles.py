"""The same queries as plain SQL over the driver tables, written independently."""

from __future__ import annotations

from rarescan.config import BANK_APPLICATIONS as ROLES
from rarescan.plans.queries import (
    FOLDS,
    GAPPY,
    MEMBERS,
    MIX,
    PER_CLASS,
    SAMPLE_ROWS,
    SEGMENT_ROWS,
    THRESHOLDS,
    TIER_THRESHOLD,
    UNDERSAMPLING_RATIO,
)
from rarescan.sources.applications import APPLICATIONS_SQL, SCORES

ORACLES: dict[str, str] = {}
NUMERIC, CATEGORICAL = list(ROLES.numeric), list(ROLES.categorical)
APPS = f"apps AS ({APPLICATIONS_SQL})"
SPACE = 16**13


def hash_sql(salt: str, key: str = "CAST(application_id AS VARCHAR)") -> str:
    return f"CAST('0x' || substr(md5({key} || ':{salt}'), 1, 13) AS BIGINT)"


def cut(fraction: float) -> int:
    return int(fraction * SPACE)


SPLIT = (
    f"split AS (SELECT *, CASE WHEN {hash_sql('42')} < {cut(0.2)} THEN 'test' ELSE 'train' END "
    "AS split FROM apps)"
)
TRAIN = f"{APPS}, {SPLIT}, train AS (SELECT * FROM split WHERE split = 'train')"
TEST = f"{APPS}, {SPLIT}, test AS (SELECT * FROM split WHERE split = 'test')"
SUMMARY = (
    "count(*) AS n_rows, CAST(sum(fraud_bool) AS BIGINT) AS n_pos, "
    "CAST(sum(application_id) AS BIGINT) AS key_sum"
)


def long_sql(columns, source="apps", extra="", kind="DOUBLE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {kind}) AS value{extra} FROM {source}"
        for c in columns
    )


def ratio(top: str, bottom: str) -> str:
    return f"(CASE WHEN ({bottom}) = 0 THEN 0.0 ELSE CAST({top} AS DOUBLE) / ({bottom}) END)"


# ---- preparation ------------------------------------------------------------------

ORACLES["split_counts"] = f"""
WITH {APPS}, {SPLIT}
SELECT split, count(*) AS n_rows, CAST(sum(fraud_bool) AS BIGINT) AS n_pos,
  round(avg(CAST(fraud_bool AS DOUBLE)), 6) AS pos_rate FROM split GROUP BY split"""

ORACLES["train_rows"] = f"WITH {TRAIN} SELECT split, {SUMMARY} FROM train GROUP BY split"

ORACLES["exact_split"] = f"""
WITH {APPS}, r AS (SELECT *, row_number() OVER (PARTITION BY fraud_bool ORDER BY {hash_sql('42')}, application_id) AS k,
  count(*) OVER (PARTITION BY fraud_bool) AS n FROM apps),
s AS (SELECT *, CASE WHEN k <= floor(n * 0.2e0 + 0.5e0) THEN 'test' ELSE 'train' END AS split FROM r)
SELECT split, fraud_bool, {SUMMARY} FROM s GROUP BY split, fraud_bool"""

ORACLES["kfold_counts"] = f"""
WITH {TRAIN} SELECT CAST({hash_sql('fold')} % {FOLDS} AS INT) AS fold, {SUMMARY} FROM train GROUP BY 1"""

ORACLES["exact_folds"] = f"""
WITH {TRAIN}, r AS (SELECT *, row_number() OVER (PARTITION BY fraud_bool ORDER BY {hash_sql('fold')}) AS k,
  count(*) OVER (PARTITION BY fraud_bool) AS n FROM train),
f AS (SELECT *, CAST({' + '.join(f'(CASE WHEN k > n * {i} // {FOLDS} THEN 1 ELSE 0 END)' for i in range(1, FOLDS))} AS INT) AS fold FROM r)
SELECT fold, fraud_bool, {SUMMARY} FROM f GROUP BY fold, fraud_bool"""

ORACLES["holdout_counts"] = f"""
WITH {TRAIN} SELECT CASE WHEN {hash_sql('holdout')} < {cut(0.2)} THEN 'test' ELSE 'train' END AS part,
  {SUMMARY} FROM train GROUP BY 1"""

ORACLES["undersample_counts"] = f"""
WITH {TRAIN}, c AS (SELECT sum(fraud_bool) / ({UNDERSAMPLING_RATIO}e0 * sum(1 - fraud_bool)) AS keep FROM train)
SELECT fraud_bool, {SUMMARY} FROM train, c
WHERE fraud_bool = 1 OR {hash_sql('under')} < floor(keep * {SPACE}) GROUP BY fraud_bool"""

ORACLES["random_sample"] = f"""
WITH {APPS} SELECT application_id, fraud_bool FROM apps
ORDER BY {hash_sql('sample')}, application_id LIMIT {SAMPLE_ROWS}"""

ORACLES["stratified_subsample"] = f"""
WITH {APPS}, c AS (SELECT count(*) AS n FROM apps)
SELECT fraud_bool, {SUMMARY} FROM apps, c
WHERE n <= {SAMPLE_ROWS} OR {hash_sql('search')} < floor({SAMPLE_ROWS}e0 / n * {SPACE}) GROUP BY fraud_bool"""


def quota_sql(source: str, salt: str, quotas: dict, columns: str) -> str:
    limits = " ".join(f"WHEN {c} THEN {n}" for c, n in quotas.items())
    return f"""(SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY fraud_bool
  ORDER BY {hash_sql(salt)}, application_id) AS k FROM {source}) WHERE k <= CASE fraud_bool {limits} END)"""


ORACLES["quota_sample"] = f"""
WITH {APPS} SELECT * FROM {quota_sql('apps', 'mix', MIX, 'application_id, fraud_bool, score_lightgbm')}"""

TIER = f"""CASE WHEN score_lightgbm > {TIER_THRESHOLD}e0 THEN 'block'
  WHEN score_lightgbm > {TIER_THRESHOLD * 0.8!r}e0 THEN 'review' ELSE 'approve' END"""
AGREES = f"CASE WHEN (CASE WHEN score_lightgbm > {TIER_THRESHOLD}e0 THEN 1 ELSE 0 END) = fraud_bool THEN 1 ELSE 0 END"

ORACLES["demo_sample"] = f"""
WITH {TEST} SELECT application_id, fraud_bool, round(score_lightgbm, 6) AS score, {TIER} AS decision,
  {AGREES} AS agrees FROM {quota_sql('test', 'demo', {1: 2, 0: 3}, '*')}"""

ORACLES["class_weights"] = f"""
WITH {TRAIN}, t AS (SELECT count(*) AS total, count(DISTINCT fraud_bool) AS k FROM train),
c AS (SELECT fraud_bool, count(*) AS n FROM train GROUP BY fraud_bool)
SELECT fraud_bool, n, round(CAST(total AS DOUBLE) / (k * n), 6) AS balanced_weight,
  CASE WHEN fraud_bool = 1 THEN 90.0e0 ELSE 1.0e0 END AS fixed_weight,
  round(CAST(total AS DOUBLE) / k, 6) AS total_weight FROM c, t"""

ORACLES["replicated_minority"] = f"""
WITH {TRAIN}, c AS (SELECT sum(1 - fraud_bool) * 1e0 / sum(fraud_bool) AS w FROM train),
r AS (SELECT train.*, CASE WHEN fraud_bool = 0 THEN 1 ELSE CAST(floor(w) AS BIGINT) +
  (CASE WHEN {hash_sql('copies')} < floor((w - floor(w)) * {SPACE}) THEN 1 ELSE 0 END) END AS m FROM train, c)
SELECT fraud_bool, CAST(sum(m) AS BIGINT) AS n_rows, CAST(sum(m * fraud_bool) AS BIGINT) AS n_pos,
  CAST(sum(m * application_id) AS BIGINT) AS key_sum FROM r GROUP BY fraud_bool"""

_REAL = {
    "income",
    "name_email_similarity",
    "days_since_request",
    "intended_balcon_amount",
    "velocity_6h",
    "velocity_24h",
    "velocity_4w",
    "proposed_credit_limit",
    "session_length_in_minutes",
}
_WHOLE = [c for c in [*NUMERIC, "fraud_bool"] if c not in _REAL]
ORACLES["type_narrowing"] = f"""
WITH {TRAIN}, v AS ({long_sql([*NUMERIC, 'fraud_bool'], 'train')}),
m AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM v GROUP BY feature)
SELECT feature, round(lo, 6) AS min_value, round(hi, 6) AS max_value,
  CASE WHEN feature NOT IN ({', '.join(repr(c) for c in _WHOLE)}) THEN 'double'
    WHEN lo > -128 AND hi < 127 THEN 'tinyint' WHEN lo > -32768 AND hi < 32767 THEN 'smallint'
    WHEN lo > -2147483648 AND hi < 2147483647 THEN 'int' ELSE 'bigint' END AS chosen_type FROM m"""

# ---- profile ----------------------------------------------------------------------

_MARKED = f"marked AS (SELECT * REPLACE ({', '.join(f'nullif({c}, -1) AS {c}' for c in ROLES.marker_flags)}) FROM apps)"
ORACLES["null_cardinality"] = (
    f"WITH {APPS}, {_MARKED} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS non_null, count(*) - count({c}) AS null_count, "
        f"round((count(*) - count({c})) * 1e0 / count(*) * 100, 6) AS null_pct, "
        f"count(DISTINCT {c}) AS n_distinct FROM marked"
        for c in ["fraud_bool", *NUMERIC, *CATEGORICAL]
    )
)

ORACLES["duplicates"] = """
WITH d AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM lineitem)), t AS (SELECT count(*) AS n FROM lineitem)
SELECT t.n AS n_rows, t.n - d.n AS n_duplicates, round((t.n - d.n) * 1e0 / t.n * 100, 6) AS duplicate_pct FROM t, d"""


def describe_sql(columns) -> str:
    return f"""SELECT feature, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
  round(max(value), 6) AS max FROM v GROUP BY feature"""


ORACLES["describe_numeric"] = (
    f"WITH {APPS}, v AS ({long_sql([*NUMERIC, 'fraud_bool'])}) {describe_sql(NUMERIC)}"
)
ORACLES["describe_bracketed"] = ORACLES["describe_numeric"]
_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
ORACLES["describe_lineitem"] = (
    f"WITH raw AS ({long_sql(_LINE, 'lineitem')}), "
    f"v AS (SELECT feature, value + 0.0 AS value FROM raw) {describe_sql(_LINE)}"
)

ORACLES["iqr_outliers"] = f"""
WITH {APPS}, v AS ({long_sql(NUMERIC)}),
q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM v GROUP BY feature),
b AS (SELECT feature, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT feature, count(*) FILTER (WHERE value < lo OR value > hi) AS outliers,
  round(count(*) FILTER (WHERE value < lo OR value > hi) * 1e0 / count(*) * 100, 6) AS outlier_pct,
  round(max(lo), 6) AS lower_bound, round(max(hi), 6) AS upper_bound
FROM v JOIN b USING (feature) GROUP BY feature"""

ORACLES["category_domain"] = f"""
WITH {APPS}, v AS ({long_sql(CATEGORICAL, kind='VARCHAR')} UNION ALL
  SELECT 'order_day', strftime(o_orderdate, '%Y-%m-%d') FROM orders),
c AS (SELECT feature, value, count(*) AS n FROM v GROUP BY feature, value),
r AS (SELECT *, count(*) OVER (PARTITION BY feature) AS n_values,
  row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS k FROM c)
SELECT feature, n_values, CASE WHEN n_values <= 30 THEN list(value ORDER BY value)
  ELSE list(value ORDER BY k) END AS domain
FROM r WHERE n_values <= 30 OR k <= 5 GROUP BY feature, n_values"""

ORACLES["target_distribution"] = f"""
WITH {APPS} SELECT fraud_bool, count(*) AS n, round(count(*) * 100e0 / sum(count(*)) OVER (), 6) AS pct
FROM apps GROUP BY fraud_bool"""

ORACLES["class_filter"] = (
    f"WITH {APPS} SELECT month, {SUMMARY} FROM apps WHERE fraud_bool = 1 GROUP BY month"
)

ORACLES["monthly_rate"] = f"""
WITH {APPS} SELECT month, count(*) AS n, CAST(sum(fraud_bool) AS BIGINT) AS pos,
  round(avg(CAST(fraud_bool AS DOUBLE)), 6) AS pos_rate FROM apps GROUP BY month"""


def risk_sql() -> str:
    return """SELECT feature, value, count(*) AS n, CAST(sum(y) AS BIGINT) AS pos,
  round(sum(y) * 1e0 / count(*), 6) AS pos_rate FROM v WHERE value IS NOT NULL GROUP BY feature, value"""


ORACLES["categorical_risk"] = (
    f"WITH {APPS}, v AS ({long_sql(CATEGORICAL, extra=', fraud_bool AS y', kind='VARCHAR')}) {risk_sql()}"
)
ORACLES["document_risk"] = f"""
WITH j AS (SELECT d.lang, d.source, l.toxic AS y FROM documents d JOIN labels l USING (doc_id)),
v AS ({long_sql(['lang', 'source'], 'j', ', y', 'VARCHAR')}) {risk_sql()}"""

ORACLES["histogram30"] = f"""
WITH {APPS}, v AS ({long_sql(NUMERIC)}),
m AS (SELECT feature, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
  CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM v GROUP BY feature),
b AS (SELECT feature, CAST(least(floor((value - lo) / (hi - lo) * 30), 29) AS INT) AS bin, lo, hi
  FROM v JOIN m USING (feature))
SELECT feature, bin, round(lo + (hi - lo) / 30 * bin, 6) AS bin_start, count(*) AS n FROM b
GROUP BY feature, bin, lo, hi"""

ORACLES["box_stats"] = f"""
WITH {APPS}, v AS ({long_sql(NUMERIC, extra=', fraud_bool AS class')}),
q AS (SELECT feature, class, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
  quantile_cont(value, 0.75) AS q3 FROM v GROUP BY feature, class),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT feature, class, round(max(q1), 6) AS q1, round(max(q2), 6) AS median, round(max(q3), 6) AS q3,
  round(min(value) FILTER (WHERE value BETWEEN lo AND hi), 6) AS whisker_low,
  round(max(value) FILTER (WHERE value BETWEEN lo AND hi), 6) AS whisker_high,
  count(*) FILTER (WHERE value NOT BETWEEN lo AND hi) AS outliers
FROM v JOIN b USING (feature, class) GROUP BY feature, class"""


def _profile_part(group: str) -> str:
    null = "NULL::DOUBLE"
    by = "" if group == "NULL::INT" else ", fraud_bool"
    num = f"""SELECT feature, {group} AS class, count(value) AS n, count(*) - count(value) AS missing,
  round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
  round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 6) AS p25,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
  round(avg(CAST(fraud_bool AS DOUBLE)), 6) AS pos_rate, count(DISTINCT value) AS n_distinct
  FROM num GROUP BY feature{by}"""
    cat = f"""SELECT feature, {group} AS class, count(value) AS n, count(*) - count(value) AS missing,
  {null}, {null}, {null}, {null}, {null}, {null}, {null},
  round(avg(CAST(fraud_bool AS DOUBLE)), 6) AS pos_rate, count(DISTINCT value) AS n_distinct
  FROM cat GROUP BY feature{by}"""
    return f"{num} UNION ALL {cat}"


ORACLES["class_profile"] = f"""
WITH {APPS}, num AS ({long_sql(NUMERIC, extra=', fraud_bool')}),
cat AS ({long_sql(CATEGORICAL, extra=', fraud_bool', kind='VARCHAR')})
{_profile_part('NULL::INT')} UNION ALL {_profile_part('fraud_bool')}"""

# ---- association --------------------------------------------------------------------

_RANKED = f"""ranked AS (SELECT application_id, feature,
  rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2e0 AS r
  FROM v)"""


def _spearman(pairs: str) -> str:
    # 0 / 0 for a constant column: no correlation
    return f"""WITH {APPS}, v AS ({long_sql([*NUMERIC, 'fraud_bool'], extra=', application_id')}), {_RANKED},
p AS (SELECT a.feature AS col1, b.feature AS col2, stddev_pop(a.r) AS sa, stddev_pop(b.r) AS sb,
  covar_pop(a.r, b.r) AS c FROM ranked a JOIN ranked b USING (application_id) {pairs} GROUP BY 1, 2)"""


ORACLES["spearman"] = (
    _spearman("")
    + " SELECT col1, col2, CASE WHEN sa * sb = 0 THEN NULL ELSE round(c / (sa * sb), 6) END AS rho FROM p"
)
ORACLES["spearman_joined"] = ORACLES["spearman"]
_GAPS = f"SELECT * REPLACE ({', '.join(f'nullif({c}, -1) AS {c}' for c in GAPPY[:2])}) FROM apps"
ORACLES["spearman_nulls"] = f"""
WITH {APPS}, gaps AS ({_GAPS}), v AS ({long_sql(GAPPY, 'gaps', ', application_id AS id')}),
j AS (SELECT a.feature AS col1, b.feature AS col2, a.value AS x, b.value AS y FROM v a JOIN v b USING (id)
  WHERE a.value IS NOT NULL AND b.value IS NOT NULL),
r AS (SELECT col1, col2, {', '.join(f"rank() OVER (PARTITION BY col1, col2 ORDER BY {c}) + (count(*) OVER (PARTITION BY col1, col2, {c}) - 1) / 2e0 AS r{c}" for c in 'xy')} FROM j)
SELECT col1, col2, round(corr(rx, ry), 6) AS rho FROM r GROUP BY col1, col2"""
ORACLES["target_correlation"] = (
    _spearman("WHERE b.feature = 'fraud_bool' AND a.feature <> 'fraud_bool'")
    + " SELECT col1 AS feature, CASE WHEN sa * sb = 0 THEN NULL ELSE round(c / (sa * sb), 6) END AS rho FROM p"
)

# erfc(x) = 1 - 2/sqrt(pi) exp(-x^2) sum 2^k x^(2k+1) / (2k+1)!!; beyond x = 5 it is 0 to 6 places
_P = """CASE WHEN z <= 0 THEN 1e0 WHEN z > 7 THEN 0e0 ELSE greatest(0e0, 1 - 2 / sqrt(pi()) * exp(-z * z / 2) *
  list_sum([exp(k * ln(2e0) + (2 * k + 1) * ln(z / sqrt(2e0)) -
  (lgamma(2 * k + 2e0) - k * ln(2e0) - lgamma(k + 1e0))) FOR k IN range(0, 200)])) END"""


def _tests(source: str, by: str = "") -> str:
    return f"""v AS ({long_sql(NUMERIC, source, f', {by}fraud_bool AS y')}),
r AS (SELECT *, rank() OVER (PARTITION BY {by}feature ORDER BY value) + (count(*) OVER (PARTITION BY {by}feature, value) - 1) / 2e0 AS r,
  count(*) OVER (PARTITION BY {by}feature, value) AS t FROM v),
s AS (SELECT {by}feature, CAST(sum(y) AS BIGINT) AS n1, CAST(sum(1 - y) AS BIGINT) AS n2, sum(CASE WHEN y = 1 THEN r ELSE 0 END) AS rs,
  sum(CAST(t AS DOUBLE) * t - 1) AS ties, count(*) * 1e0 AS n FROM r GROUP BY {by}feature),
u AS (SELECT *, rs - n1 * (n1 + 1) / 2e0 AS u_stat, n1 * 1e0 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))) AS var FROM s),
tests AS (SELECT {by}feature, n1, n2, u_stat, CASE WHEN var > 1e-9 THEN
  (greatest(u_stat, n1 * 1e0 * n2 - u_stat) - n1 * 1e0 * n2 / 2 - 0.5) / sqrt(var) ELSE 0e0 END AS z FROM u),
tested AS (SELECT *, {_P} AS p FROM tests)"""


ORACLES["mann_whitney_u"] = f"""
WITH {APPS}, {_tests('apps')}
SELECT feature, n1, n2, u_stat, round(z, 6) AS z, round(p, 6) AS p_value,
  CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS conclusion FROM tested"""

ORACLES["mann_whitney_buckets"] = ORACLES["mann_whitney_u"]

# All subsets of the ranks 1 to k, counted by size and sum.
_SUBSETS = ["d0 AS (SELECT 0 AS j, 0 AS s, 1e0 AS c)"] + [
    f"d{k} AS (SELECT j, s, sum(c) AS c FROM (FROM d{k - 1} UNION ALL SELECT j + 1, s + {k}, c FROM d{k - 1}) GROUP BY j, s)"
    for k in range(1, SEGMENT_ROWS + 1)
]
ORACLES["mann_whitney_segments"] = f"""
WITH {APPS}, cut AS (SELECT *, application_id // {SEGMENT_ROWS} AS segment FROM apps), {_tests('cut', 'segment, ')},
{', '.join(_SUBSETS)},
d AS ({' UNION ALL '.join(f'SELECT {k} AS n, j, s - j * (j + 1) / 2e0 AS u, c FROM d{k}' for k in range(1, SEGMENT_ROWS + 1))}),
sides AS (SELECT segment, feature, least(u_stat, n1 * 1e0 * n2 - u_stat) AS most FROM u),
exact AS (SELECT u.segment, u.feature, least(1e0, 2 * sum(CASE WHEN d.u <= most THEN c ELSE 0e0 END) / sum(c)) AS p
  FROM u JOIN sides USING (segment, feature) JOIN d ON d.n = u.n1 + u.n2 AND d.j = u.n1
  WHERE ties = 0 AND least(n1, n2) BETWEEN 1 AND 8 GROUP BY 1, 2),
answers AS (SELECT t.* EXCLUDE (p), coalesce(e.p, t.p) AS p FROM tested t LEFT JOIN exact e USING (segment, feature))
SELECT segment, feature, n1, n2, u_stat, round(z, 6) AS z, round(p, 6) AS p_value,
  CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS conclusion FROM answers"""
ORACLES["mann_whitney_sampled"] = f"""
WITH {APPS},
picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fraud_bool ORDER BY {hash_sql('ranktest')}, application_id) AS k
  FROM apps) WHERE k <= {PER_CLASS}), {_tests('picked')}
SELECT feature, n1, n2, u_stat, round(z, 6) AS z FROM tests"""



def _digamma(n: str) -> str:
    x = f"({n} + 8e0)"
    back = " - ".join(f"1 / ({n} + {j}e0)" for j in range(8))
    return f"(ln({x}) - 1 / (2 * {x}) - 1 / (12 * {x} * {x}) + 1 / (120 * pow({x}, 4)) - 1 / (252 * pow({x}, 6)) - {back})"


_JITTER = hash_sql("mi", "CAST(application_id AS VARCHAR) || ':' || feature")
ORACLES["mi_knn"] = f"""
WITH {APPS}, v AS ({long_sql(NUMERIC, extra=', fraud_bool AS y, application_id')}),
m AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM v GROUP BY feature),
g AS (SELECT feature, y, application_id, {_JITTER} // {1 << 32} + CASE WHEN lo = hi THEN 0 ELSE
  CAST(floor((value - lo) / (hi - lo) * {1 << 40}e0) AS BIGINT) * {1 << 20} END AS x FROM v JOIN m USING (feature)),
d AS (SELECT *, count(*) OVER (PARTITION BY feature, y) AS size,
  {', '.join(f"x - lag(x, {i}) OVER w AS l{i}, lead(x, {i}) OVER w - x AS r{i}" for i in (1, 2, 3))}
  FROM g WINDOW w AS (PARTITION BY feature, y ORDER BY x, application_id)),
r AS (SELECT *, greatest(1, list_min([r3, CASE WHEN l1 IS NOT NULL AND r2 IS NOT NULL THEN greatest(l1, r2) END,
  CASE WHEN l2 IS NOT NULL AND r1 IS NOT NULL THEN greatest(l2, r1) END, l3])) - 1 AS reach FROM d),
n AS (SELECT *, count(*) OVER (PARTITION BY feature ORDER BY x RANGE BETWEEN reach PRECEDING AND reach FOLLOWING) AS near FROM r)
SELECT feature, round(greatest(0, {_digamma('count(*)')} + avg({_digamma('3e0')} - {_digamma('size')} - {_digamma('near')})), 6) AS mi
FROM n GROUP BY feature"""

_CUTS = ", ".join(repr(i / 10) for i in range(1, 10))
_MI = f"""mv AS ({long_sql(NUMERIC, extra=', fraud_bool AS y')}),
mq AS (SELECT feature, list_distinct(quantile_cont(value, [{_CUTS}])) AS cuts FROM mv GROUP BY feature),
mb AS (SELECT feature, y, len(list_filter(cuts, lambda c: c < value)) AS bin FROM mv JOIN mq USING (feature)),
xy AS (SELECT feature, bin, y, count(*) * 1e0 AS n FROM mb GROUP BY ALL),
w AS (SELECT *, sum(n) OVER (PARTITION BY feature, bin) AS nx, sum(n) OVER (PARTITION BY feature, y) AS ny,
  sum(n) OVER (PARTITION BY feature) AS total FROM xy),
mi AS (SELECT feature, sum(n / total * ln(n * total / (nx * ny))) AS mi,
  (count(DISTINCT bin) - 1) * (count(DISTINCT y) - 1) / (2 * max(total)) AS bias FROM w GROUP BY feature)"""

ORACLES["mi_binned"] = f"""
WITH {APPS}, {_MI}
SELECT feature, round(abs(mi), 6) AS mi, round(greatest(mi - bias, 0), 6) AS mi_adjusted FROM mi"""

ORACLES["screen_features"] = f"""
WITH {APPS}, {_tests('apps')}, {_MI},
q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
  stddev_samp(value) AS sd FROM v GROUP BY feature),
o AS (SELECT feature, max(sd) AS sd, avg(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)
  THEN 100e0 ELSE 0e0 END) AS pct FROM v JOIN q USING (feature) GROUP BY feature),
f AS (SELECT feature, sd = 0 AS constant, pct > 15 AS wide, greatest(mi - bias, 0) < 0.0001 AND p >= 0.05 AS silent
  FROM o JOIN mi USING (feature) JOIN tested USING (feature))
SELECT feature, CASE WHEN constant OR silent THEN 'drop' WHEN wide THEN 'clip' ELSE 'keep' END AS action,
  CASE WHEN constant THEN 'constant' WHEN silent THEN 'no signal' WHEN wide THEN 'many outliers' ELSE '' END AS reason FROM f"""

# ---- curves ---------------------------------------------------------------------------

_POINTS = f"""sv AS ({' UNION ALL '.join(f"SELECT '{s}' AS model, {s} AS score, fraud_bool AS y FROM apps" for s in SCORES)}),
g AS (SELECT model, score, count(*) AS n, sum(y) AS pos FROM sv GROUP BY model, score),
pts AS (SELECT model, score AS threshold, n, pos,
  sum(pos) OVER d AS tp, sum(n - pos) OVER d AS fp, sum(pos) OVER (PARTITION BY model) AS np,
  sum(n - pos) OVER (PARTITION BY model) AS nn FROM g
  WINDOW d AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
pr AS (SELECT *, {ratio('tp', 'tp + fp')} AS p, {ratio('tp', 'np')} AS r, {ratio('fp', 'nn')} AS f FROM pts)"""

ORACLES["roc_curve"] = f"""
WITH {APPS}, {_POINTS} SELECT model, round(threshold, 6) AS threshold, round(f, 6) AS fpr, round(r, 6) AS tpr FROM pr
UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0e0, 0e0 FROM pr"""

ORACLES["pr_curve"] = f"""
WITH {APPS}, {_POINTS} SELECT model, round(threshold, 6) AS threshold, round(p, 6) AS precision, round(r, 6) AS recall FROM pr
UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 1e0, 0e0 FROM pr"""

ORACLES["threshold_tradeoff"] = f"""
WITH {APPS}, {_POINTS} SELECT model, round(threshold, 6) AS threshold, round(p, 6) AS precision, round(r, 6) AS recall FROM pr"""

ORACLES["roc_auc"] = f"""
WITH {APPS}, sv AS ({' UNION ALL '.join(f"SELECT '{s}' AS model, {s} AS score, fraud_bool AS y FROM apps" for s in SCORES)}),
rk AS (SELECT model, y, rank() OVER (PARTITION BY model ORDER BY score) +
  (count(*) OVER (PARTITION BY model, score) - 1) / 2e0 AS r FROM sv)
SELECT model, CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1 - y) AS BIGINT) AS n_neg,
  round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2e0) / (sum(y) * sum(1 - y)), 6) AS roc_auc
FROM rk GROUP BY model"""

ORACLES["average_precision"] = f"""
WITH {APPS}, {_POINTS}, st AS (SELECT *, r - lag(r, 1, 0e0) OVER (PARTITION BY model ORDER BY threshold DESC) AS dr FROM pr)
SELECT model, round(sum(dr * p), 6) AS pr_auc, round(max(np) * 1e0 / max(np + nn), 6) AS prevalence FROM st GROUP BY model"""


def _best(beta: float) -> str:
    b2 = beta * beta
    return f"""SELECT model, {beta}e0 AS beta, round(threshold, 6) AS threshold, round(fb, 6) AS fbeta, round(p, 6) AS precision,
  round(r, 6) AS recall FROM (SELECT *, (1 + {b2}) * (p * r) / ({b2} * p + r + 1e-10) AS fb FROM pr)
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY fb DESC, threshold) = 1"""


ORACLES["best_fbeta"] = f"WITH {APPS}, {_POINTS} ({_best(1.0)}) UNION ALL ({_best(2.0)})"


def _target(target: float) -> str:
    return f"""SELECT m.model, {target}e0 AS target, round(threshold, 6) AS threshold, round(p, 6) AS precision,
  round(r, 6) AS recall, round(mp, 6) AS max_precision
  FROM (SELECT model, max(p) AS mp FROM pr GROUP BY model) m LEFT JOIN (SELECT * FROM pr WHERE p >= {target}
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY r DESC, threshold) = 1) b ON b.model = m.model"""


ORACLES["precision_target"] = f"WITH {APPS}, {_POINTS} " + " UNION ALL ".join(
    f"({_target(t)})" for t in (0.20, 0.95, 0.999)
)

_ALL_CUTS = [(f"{s}|default", s, 0.5) for s in SCORES] + [
    (f"{s}|tuned", s, t) for s, t in THRESHOLDS.items()
]
_COUNTS = "cm AS (" + " UNION ALL ".join(
    f"""SELECT '{n}' AS name, '{s}' AS model, {t}e0 AS threshold,
  count(*) FILTER (WHERE fraud_bool = 0 AND {s} < {t}e0) AS tn, count(*) FILTER (WHERE fraud_bool = 0 AND {s} >= {t}e0) AS fp,
  count(*) FILTER (WHERE fraud_bool = 1 AND {s} < {t}e0) AS fn, count(*) FILTER (WHERE fraud_bool = 1 AND {s} >= {t}e0) AS tp
  FROM apps"""
    for n, s, t in _ALL_CUTS
) + ")"

ORACLES["confusion"] = f"WITH {APPS}, {_COUNTS} " + " UNION ALL ".join(
    f"SELECT name, model, threshold, {a} AS label, {p} AS predicted, {c} AS n FROM cm"
    for c, a, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
)

ORACLES["binary_metrics"] = f"""
WITH {APPS}, {_COUNTS} SELECT *, round({ratio('tp', 'tp + fp')}, 6) AS precision, round({ratio('tp', 'tp + fn')}, 6) AS recall,
  round({ratio('2 * tp', '2 * tp + fp + fn')}, 6) AS f1, round({ratio('tp + tn', 'tp + tn + fp + fn')}, 6) AS accuracy,
  round({ratio('tn', 'tn + fp')}, 6) AS tn_rate, round({ratio('fp', 'tn + fp')}, 6) AS fp_rate,
  round({ratio('tp', 'tp + fn')}, 6) AS tp_rate, round({ratio('fn', 'tp + fn')}, 6) AS fn_rate FROM cm"""

_REPORT = f"""x AS (SELECT name, tn + fp AS s0, tp + fn AS s1, {ratio('tn', 'tn + fn')} AS p0, {ratio('tn', 'tn + fp')} AS r0,
  {ratio('2 * tn', '2 * tn + fp + fn')} AS f0, {ratio('tp', 'tp + fp')} AS p1, {ratio('tp', 'tp + fn')} AS r1,
  {ratio('2 * tp', '2 * tp + fp + fn')} AS f1 FROM cm)"""
ORACLES["class_report"] = f"""
WITH {APPS}, {_COUNTS}, {_REPORT}
SELECT name, '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM x
UNION ALL SELECT name, '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM x
UNION ALL SELECT name, 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), s0 + s1 FROM x
UNION ALL SELECT name, 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
  round((f0 * s0 + f1 * s1) / (s0 + s1), 6), s0 + s1 FROM x"""

_SIDE = f"""y AS (SELECT model, string_split(name, '|')[2] AS side, {ratio('tp', 'tp + fp')} AS precision,
  {ratio('tp', 'tp + fn')} AS recall, {ratio('2 * tp', '2 * tp + fp + fn')} AS f1 FROM cm)"""
ORACLES["compare_thresholds"] = (
    f"WITH {APPS}, {_COUNTS}, {_SIDE} SELECT a.model, "
    + ", ".join(
        f"round(a.{m}, 6) AS {m}_default, round(b.{m}, 6) AS {m}_tuned, round(b.{m} - a.{m}, 6) AS {m}_gain"
        for m in ("f1", "precision", "recall")
    )
    + " FROM y a JOIN y b ON a.model = b.model AND a.side = 'default' AND b.side = 'tuned'"
)

# ---- decisions ---------------------------------------------------------------------------

ORACLES["three_tier"] = f"""
WITH {APPS} SELECT {TIER} AS decision, {AGREES} AS agrees, count(*) AS n, CAST(sum(application_id) AS BIGINT) AS key_sum
FROM apps GROUP BY 1, 2"""


def committee_sql(source: str) -> str:
    votes = ", ".join(
        f"CASE WHEN {s} >= {t}e0 THEN 1 ELSE 0 END AS v_{m}" for m, (s, t) in MEMBERS.items()
    )
    active = " + ".join(f"(CASE WHEN {s} IS NULL THEN 0 ELSE 1 END)" for s, _ in MEMBERS.values())
    cast = " + ".join(f"v_{m}" for m in MEMBERS)
    return f"""voted AS (SELECT *, {votes}, {active} AS active_models FROM {source}),
summed AS (SELECT *, {cast} AS fraud_votes FROM voted),
decided AS (SELECT *, CASE WHEN active_models = 0 THEN 'error' WHEN fraud_votes >= active_models // 2 + 1 THEN 'block'
    WHEN fraud_votes = 1 AND v_mlp = 1 THEN 'review' ELSE 'approve' END AS decision,
  CASE WHEN active_models = 0 THEN 'no active model'
    WHEN fraud_votes >= active_models // 2 + 1 AND fraud_votes = active_models THEN 'high: unanimous'
    WHEN fraud_votes >= active_models // 2 + 1 THEN 'medium: majority'
    WHEN fraud_votes = 1 AND v_mlp = 1 THEN 'medium: single veto'
    WHEN fraud_votes > 0 THEN 'medium: minor disagreement, risk accepted' ELSE 'high: clear' END AS confidence FROM summed),
judged AS (SELECT *, CASE decision WHEN 'block' THEN CASE WHEN fraud_bool = 1 THEN 'TP' ELSE 'FP' END WHEN 'review' THEN 'RM'
    WHEN 'approve' THEN CASE WHEN fraud_bool = 1 THEN 'FN' ELSE 'TN' END END AS outcome FROM decided)"""


ORACLES["committee_decision"] = f"""
WITH {APPS}, {committee_sql('apps')}
SELECT application_id, decision, confidence, fraud_votes, active_models FROM decided"""

ORACLES["committee_partial"] = f"""
WITH {APPS}, gaps AS (SELECT application_id, fraud_bool, CASE WHEN month < 6 THEN score_xgboost END AS score_xgboost,
  CASE WHEN month < 4 THEN score_lightgbm END AS score_lightgbm, CASE WHEN month <> 7 THEN score_mlp END AS score_mlp FROM apps),
{committee_sql('gaps')}
SELECT active_models, decision, confidence, count(*) AS n, CAST(sum(application_id) AS BIGINT) AS key_sum
FROM decided GROUP BY 1, 2, 3"""

ORACLES["committee_votes"] = f"WITH {APPS}, {committee_sql('apps')} " + " UNION ALL ".join(
    f"SELECT '{m}' AS model, v_{m} AS vote, count(*) AS n, CAST(sum(application_id) AS BIGINT) AS key_sum, "
    f"{t}e0 AS threshold FROM voted GROUP BY v_{m}"
    for m, (_, t) in MEMBERS.items()
)

ORACLES["committee_details"] = (
    f"WITH {APPS}, {committee_sql('apps')} SELECT application_id, decision, "
    + ", ".join(f"round({s}, 4) AS {m}_score, v_{m} AS {m}_vote" for m, (s, _) in MEMBERS.items())
    + " FROM decided"
)

ORACLES["outcome_counts"] = (
    f"WITH {APPS}, {committee_sql('apps')} SELECT outcome, count(*) AS n FROM judged GROUP BY outcome"
)

_COST = f"""totals AS (SELECT count(*) AS total, count(*) FILTER (WHERE fraud_bool = 0) AS n_legit,
  count(*) FILTER (WHERE fraud_bool = 1) AS n_fraud, {', '.join(f"count(*) FILTER (WHERE outcome = '{k}') AS {k.lower()}" for k in ('TP', 'TN', 'FN', 'FP', 'RM'))} FROM judged)
SELECT *, round({ratio('tp + tn', 'total - rm')} * 100, 6) AS hit_rate_pct, round({ratio('fp', 'n_legit')} * 100, 6) AS friction_pct,
  tp * 3500e0 AS saved, fn * 3500e0 AS lost, n_legit * 3500e0 AS legit_revenue FROM totals"""
ORACLES["cost_report"] = f"WITH {APPS}, {committee_sql('apps')}, {_COST}"
ORACLES["mix_cost_report"] = f"""
WITH {APPS}, mix AS {quota_sql('apps', 'mix', MIX, '*')}, {committee_sql('mix')}, {_COST}"""

# ---- features ------------------------------------------------------------------------------

_CLIP_INPUT = {
    c: f"nullif({c}, -1)" if c in ROLES.marker_flags else c for c in ROLES.clipped
}
_BOUNDS = "bounds AS (SELECT " + ", ".join(
    f"quantile_cont(CAST({e} AS DOUBLE), {p}) AS {c}_{side}"
    for c, e in _CLIP_INPUT.items()
    for side, p in (("lo", 0.01), ("hi", 0.99))
) + " FROM split WHERE split = 'train')"

ORACLES["clip_bounds"] = f"WITH {APPS}, {SPLIT}, {_BOUNDS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round({c}_lo, 6) AS lower, round({c}_hi, 6) AS upper FROM bounds"
    for c in ROLES.clipped
)

_REPLACED = {c: f"CAST(nullif({c}, -1) AS DOUBLE)" for c in ROLES.marker_flags}
for _c in ROLES.clipped:
    _e = _REPLACED.get(_c, f"CAST({_c} AS DOUBLE)")
    _REPLACED[_c] = f"CASE WHEN {_e} IS NULL THEN NULL ELSE greatest(least({_e}, {_c}_hi), {_c}_lo) END"
_STEP1 = f"""step1 AS (SELECT split.* EXCLUDE ({', '.join(ROLES.no_signal)}) REPLACE ({', '.join(f'{e} AS {c}' for c, e in _REPLACED.items())}),
  {', '.join(f"CASE WHEN split.{c} = -1 THEN 0 ELSE 1 END AS {f}" for c, f in ROLES.marker_flags.items())},
  {', '.join(f"CASE WHEN split.{c} = '{v}' THEN 1 ELSE 0 END AS {f}" for c, (v, f) in ROLES.risk_flags.items())}
  FROM split, bounds)"""
_MADE = {
    "digital_risk_score": "email_is_free * device_distinct_emails_8w",
    "velocity_anomaly": "velocity_6h / nullif(velocity_4w + 1, 0)",
    "credit_utilization": "intended_balcon_amount / nullif(proposed_credit_limit + 1, 0)",
    "age_income_risk": "customer_age * income",
    "multi_risk_flag": "is_high_risk_housing * is_high_risk_os * email_is_free",
    "phone_mismatch": "CASE WHEN phone_home_valid <> phone_mobile_valid THEN 1 ELSE 0 END",
    "email_velocity_risk": "email_is_free * velocity_6h",
    "address_stability": "current_address_months_count / nullif(customer_age * 12e0 + 1, 0)",
}
_FE = (
    f"{APPS}, {SPLIT}, {_BOUNDS}, {_STEP1}, fe AS (SELECT *, "
    + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in _MADE.items())
    + " FROM step1)"
)
_FE_NUMERIC = [
    *[c for c in NUMERIC if c not in ROLES.no_signal],
    *ROLES.marker_flags.values(),
    *[f for _, f in ROLES.risk_flags.values()],
    *_MADE,
]

ORACLES["engineered_features"] = (
    f"WITH {_FE} SELECT application_id, "
    + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in _FE_NUMERIC)
    + f", {', '.join(CATEGORICAL)} FROM fe"
)

_MEDIANS = "med AS (SELECT " + ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in _FE_NUMERIC
) + " FROM fe WHERE split = 'train')"
_FILLED = "filled AS (SELECT application_id, split, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in _FE_NUMERIC
) + " FROM fe, med)"
_SPREAD = "spread AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.5) AS c_{c}, CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) < 2.3e-15 "
    f"THEN 1 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS s_{c}"
    for c in _FE_NUMERIC
) + " FROM filled WHERE split = 'train')"
ORACLES["robust_scaled"] = (
    f"WITH {_FE}, {_MEDIANS}, {_FILLED}, {_SPREAD} SELECT application_id, "
    + ", ".join(f"round(({c} - c_{c}) / s_{c}, 6) AS {c}" for c in _FE_NUMERIC)
    + " FROM filled, spread"
)

# levels seen in train; payment type AE is held back from fitting
_LEVELS = {
    "payment_type": ["AA", "AB", "AC", "AD"],
    "employment_status": ["CA", "CB", "CC", "CD", "CE", "CF", "CG"],
    "housing_status": ["BA", "BB", "BC", "BD", "BE", "missing"],
    "source": ["INTERNET", "TELEAPP"],
    "device_os": ["linux", "macintosh", "other", "windows", "x11"],
}


def _filled(column: str) -> str:
    gap = "CASE WHEN month = 0 THEN 'missing' ELSE housing_status END"
    return gap if column == "housing_status" else column


ORACLES["one_hot"] = (
    f"WITH {APPS} SELECT application_id, "
    + ", ".join(
        f"CASE WHEN {_filled(c)} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}"
        for c, levels in _LEVELS.items()
        for v in levels
    )
    + " FROM apps"
)

# ---- run facts --------------------------------------------------------------------------------

ORACLES["split_roundtrip"] = f"WITH {TEST} SELECT split, month, {SUMMARY} FROM test GROUP BY split, month"

_MONTHLY = f"""sv AS ({' UNION ALL '.join(f"SELECT '{s}' AS model, month, {s} AS score, fraud_bool AS y FROM apps" for s in SCORES)}),
g AS (SELECT model, month, score, count(*) AS n, sum(y) AS pos FROM sv GROUP BY model, month, score),
pts AS (SELECT model, month, score AS threshold, n, pos, sum(pos) OVER d AS tp, sum(n - pos) OVER d AS fp,
  sum(pos) OVER m AS np, sum(n - pos) OVER m AS nn FROM g
  WINDOW d AS (PARTITION BY model, month ORDER BY score DESC ROWS UNBOUNDED PRECEDING), m AS (PARTITION BY model, month)),
pr AS (SELECT *, {ratio('tp', 'tp + fp')} AS p, {ratio('tp', 'np')} AS r FROM pts),
runs AS (SELECT model, 'run_' || CAST(month AS VARCHAR) AS run_id,
  sum(pos * (nn - fp + (n - pos) / 2e0)) / (max(np) * max(nn)) AS roc_auc, sum(pos * p) / max(np) AS pr_auc
  FROM pr GROUP BY model, month)"""

ORACLES["threshold_store"] = f"""
WITH {APPS}, {_MONTHLY},
best AS (SELECT model, month, threshold FROM (SELECT *, 2 * (p * r) / (p + r + 1e-10) AS fb FROM pr)
  WHERE model <> 'score_mlp' AND month < 7
  QUALIFY row_number() OVER (PARTITION BY model, month ORDER BY fb DESC, threshold) = 1),
latest AS (SELECT model, arg_max(threshold, month) AS threshold FROM best GROUP BY model),
wanted AS (SELECT DISTINCT model FROM sv)
SELECT model, round(coalesce(threshold, 0.5), 6) AS threshold,
  CASE WHEN threshold IS NULL THEN 'default' ELSE 'saved' END AS source FROM wanted LEFT JOIN latest USING (model)"""

ORACLES["experiment_latest"] = f"""
WITH {APPS}, {_MONTHLY}, newest AS (SELECT model, max(run_id) AS run_id FROM runs GROUP BY model)
SELECT n.model, n.run_id, CASE WHEN n.model <> 'score_mlp' OR n.run_id <> 'run_7' THEN round(roc_auc, 6) END AS roc_auc,
  CASE WHEN n.model <> 'score_mlp' OR n.run_id <> 'run_7' THEN round(pr_auc, 6) END AS pr_auc
FROM newest n JOIN runs r ON r.model = n.model AND r.run_id = n.run_id"""

ORACLES["experiment_leaderboard"] = f"""
WITH {APPS}, {_MONTHLY}
SELECT model, count(*) AS runs, round(avg(roc_auc), 6) AS roc_auc_mean, round(stddev_samp(roc_auc), 6) AS roc_auc_std,
  round(max(roc_auc), 6) AS roc_auc_best, round(avg(pr_auc), 6) AS pr_auc_mean, round(stddev_samp(pr_auc), 6) AS pr_auc_std,
  round(max(pr_auc), 6) AS pr_auc_best FROM runs GROUP BY model"""

ORACLES["csv_roundtrip"] = f"""
WITH {APPS} SELECT month, housing_status, count(*) AS n, CAST(sum(fraud_bool) AS BIGINT) AS pos,
  CAST(sum(zip_count_4w) AS BIGINT) AS zip_sum, max(velocity_24h) AS velocity_max FROM apps GROUP BY month, housing_status"""

# ---- streams ------------------------------------------------------------------------------------

ORACLES["stream_decisions"] = f"""
WITH {APPS}, {committee_sql('apps')}
SELECT decision, outcome, count(*) AS n, CAST(sum(application_id) AS BIGINT) AS key_sum FROM judged GROUP BY 1, 2"""
ORACLES["stream_running_totals"] = ORACLES["outcome_counts"]
ORACLES["stream_running_cost"] = ORACLES["cost_report"]

ORACLES["stream_event_tiers"] = """
WITH e AS (SELECT *, least(value / 500e0, 0.999e0) AS score, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y FROM events),
d AS (SELECT *, CASE WHEN score > 0.7e0 THEN 'block' WHEN score > 0.7e0 * 0.8e0 THEN 'review' ELSE 'approve' END AS decision FROM e)
SELECT strftime(ts, '%Y-%m-%d') AS day, decision, CASE decision WHEN 'block' THEN CASE WHEN y = 1 THEN 'TP' ELSE 'FP' END
  WHEN 'review' THEN 'RM' ELSE CASE WHEN y = 1 THEN 'FN' ELSE 'TN' END END AS outcome,
  count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM d GROUP BY 1, 2, 3"""


# ---- models -----------------------------------------------------------------------------

_SCORED = "application_id, fraud_bool, TRUE AS is_score, TRUE AS auc_reached"
for _name in (
    "lr_scores", "tree_scores", "rf_scores", "gbt_scores", "gbt_leaf_scores", "mlp_scores",
    "undersampled_scores", "stacked_scores",
):
    ORACLES[_name] = f"WITH {TEST} SELECT {_SCORED} FROM test"
ORACLES["iforest_scores"] = f"WITH {TRAIN} SELECT {_SCORED}, TRUE AS spans_range FROM train"
ORACLES["lr_search"] = "SELECT 10 AS n_tried, TRUE AS in_grid, TRUE AS auc_reached"
ORACLES["gbt_random_search"] = "SELECT 60 AS n_tried, TRUE AS in_space, TRUE AS auc_reached"
ORACLES["rf_importance"] = "SELECT 20 AS n_listed, TRUE AS is_sorted, 1e0 AS total"
ORACLES["lr_explanations"] = f"WITH {TEST} SELECT application_id, TRUE AS all_terms, TRUE AS adds_up FROM test"
ORACLES["tuned_threshold"] = "SELECT TRUE AS is_threshold, TRUE AS is_f1"

# One tree per fold left out (and of all rows, -1), best leaf first: four times the best split of all leaves.
_LONG = " UNION ALL ".join(
    f"SELECT application_id AS id, {i} AS f, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM train"
    for i, c in enumerate(
        ("month", "prev_address_months_count", "customer_age", "date_of_birth_distinct_emails_4w", "keep_alive_session")
    )
)


def _gain(g: str, h: str) -> str:
    return f"power(greatest(abs({g}) - 0.5, 0), 2) / ({h} + 2)"


def _step(k: int) -> str:
    """Rows n{k} to n{k + 1}: the best split s{k} of each model divides one leaf."""
    return f"""
a{k} AS (SELECT m, path, f, feature, x, sum(g) AS g, sum(h) AS h, count(*) AS c FROM n{k} JOIN long USING (id) GROUP BY ALL),
b{k} AS (SELECT *, sum(g) OVER l AS gl, sum(h) OVER l AS hl, sum(c) OVER l AS cl, sum(g) OVER w AS gw, sum(h) OVER w AS hw, sum(c) OVER w AS cw
  FROM a{k} WINDOW w AS (PARTITION BY m, path, f), l AS (PARTITION BY m, path, f ORDER BY x)),
c{k} AS (SELECT *, {_gain('gl', 'hl')} + {_gain('(gw - gl)', '(hw - hl)')} - {_gain('gw', 'hw')} AS gain FROM b{k}
  WHERE least(hl, hw - hl) >= 5 AND least(cl, cw - cl) >= 30),
s{k} AS (SELECT m, path, f, feature, x AS cut, gain FROM c{k} WHERE gain > 1e-6
  QUALIFY row_number() OVER (PARTITION BY m ORDER BY gain DESC, path, f, x) = 1),
n{k + 1} AS (SELECT n.m, n.id, g, h, n.path || CASE WHEN s.path IS NULL THEN '' WHEN x <= cut THEN 'L' ELSE 'R' END AS path
  FROM n{k} n LEFT JOIN s{k} s ON s.m = n.m AND s.path = n.path LEFT JOIN long ON long.id = n.id AND long.f = s.f)"""


ORACLES["boost_leafwise_trees"] = f"""
WITH {TRAIN}, long AS ({_LONG}),
w AS (SELECT m, application_id AS id, fraud_bool AS y, CASE fraud_bool WHEN 1 THEN 3e0 ELSE 1e0 END AS w
  FROM train, (VALUES (0), (1), (2), (-1)) AS v(m) WHERE application_id % 3 <> m),
p AS (SELECT m, sum(w * y) / sum(w) AS p FROM w GROUP BY m),
n0 AS (SELECT m, id, '' AS path, w * (p - y) AS g, w * p * (1 - p) AS h FROM w JOIN p USING (m)),
{','.join(map(_step, range(4)))},
leaves AS (SELECT m, path, sum(g) AS g, sum(h) AS h FROM n4 GROUP BY m, path)
SELECT m AS without_fold, path, feature, cut, round(gain, 6) AS value FROM
  ({' UNION ALL '.join(f'SELECT m, path, feature, cut, gain FROM s{k}' for k in range(4))})
UNION ALL SELECT m, path, NULL, NULL, round(-0.3 * sign(g) * greatest(abs(g) - 0.5, 0) / (h + 2), 6) FROM leaves"""

_SLOPES = ["e * a * s1", "e * a * s2", "e * b * s1", "e * b * s2", "e * s1", "e * s2", "w * (p - y) * h1", "w * (p - y) * h2", "w * (p - y)"]
ORACLES["mlp_gradient"] = f"""
WITH {TRAIN}, x AS (SELECT 'weighted' AS rows, 1 + 2 * fraud_bool AS w, fraud_bool AS y, coalesce(month, 0) / 4e0 AS a,
    coalesce(customer_age, 0) / 50e0 AS b FROM train),
r AS (FROM x UNION ALL SELECT 'repeated', 1, y, a, b FROM (SELECT *, unnest(range(0, w)) FROM x)),
h AS (SELECT *, tanh(0.3e0 * a + 0.1e0 * b + 0.05e0) AS h1, tanh(-0.2e0 * a + 0.4e0 * b - 0.1e0) AS h2 FROM r),
m AS (SELECT *, 0.7e0 * h1 - 0.5e0 * h2 + 0.2e0 AS m FROM h),
e AS (SELECT *, 1 / (1 + exp(-m)) AS p, w * (1 / (1 + exp(-m)) - y) AS e,
  0.7e0 * (1 - h1 * h1) AS s1, -0.5e0 * (1 - h2 * h2) AS s2 FROM m)
SELECT rows, -1 AS place, round(sum(w * (ln(1 + exp(m)) - y * m)) / sum(w), 6) AS value FROM e GROUP BY rows
{' '.join(f'UNION ALL SELECT rows, {k}, round(sum({v}) / sum(w), 6) FROM e GROUP BY rows' for k, v in enumerate(_SLOPES))}"""



def _det(a: list[list[str]]) -> str:
    """Determinant of three rows of three expressions."""
    minor = lambda i, j: f"(({a[1][i]}) * ({a[2][j]}) - ({a[1][j]}) * ({a[2][i]}))"
    return f"(({a[0][0]}) * {minor(1, 2)} - ({a[0][1]}) * {minor(0, 2)} + ({a[0][2]}) * {minor(0, 1)})"


def _newton(k: int, last: str, ridge: int, pull: tuple[str, str, str]) -> str:
    """Rows ``last`` to n{k}: one Newton step to where the slope of the loss is ``-pull``."""
    h = [[f"c * h{min(i, j)}{max(i, j)}" + (f" + {ridge}" if i == j else "") for j in range(3)] for i in range(3)]
    g = [f"c * g{i} + {pull[i]}" for i in range(3)]
    moved = [
        f"b{i} - {_det([[g[r] if j == i else h[r][j] for j in range(3)] for r in range(3)])} / {_det(h)} AS b{i}"
        for i in range(3)
    ]
    u = ("u0", "u1", "1e0")
    sums = [f"sum(w * (p - y) * {u[i]}) AS g{i}" for i in range(3)]
    sums += [f"sum(w * p * (1 - p) * {u[i]} * {u[j]}) AS h{i}{j}" for i in range(3) for j in range(i, 3)]
    return f"""
n{k} AS MATERIALIZED (SELECT m, c, {', '.join(moved)}, s0, s1, s2 FROM (SELECT m, c, b0, b1, b2, s0, s1, s2, {', '.join(sums)}
  FROM (SELECT *, 1 / (1 + exp(-(b0 * u0 + b1 * u1 + b2))) AS p FROM {last} JOIN r USING (m)) GROUP BY m, c, b0, b1, b2, s0, s1, s2))"""


# The l1 minimum has the signs of the l2 one here; there its slope is their negative.
_NEWTON = 10
_RIDGE = ("b0", "b1", "b2")
_SIGNS = ("s0", "s1", "s2")
ORACLES["lr_coefficients"] = f"""
WITH {TRAIN},
r AS MATERIALIZED (SELECT m, coalesce(customer_age, 0) / 50e0 AS u0, CAST(coalesce(keep_alive_session, 0) AS DOUBLE) AS u1,
  fraud_bool AS y, sum(1e0 + 20 * fraud_bool) AS w
  FROM train, (VALUES (0), (1), (2), (-1)) AS v(m) WHERE application_id % 3 <> m GROUP BY ALL),
n0 AS (SELECT m, c, 0e0 AS b0, 0e0 AS b1, 0e0 AS b2, 0e0 AS s0, 0e0 AS s1, 0e0 AS s2
  FROM (SELECT DISTINCT m FROM r), (VALUES (0.1e0), (1e0), (10e0)) AS v(c)),
{','.join(_newton(k + 1, f'n{k}', 1, _RIDGE) for k in range(_NEWTON))},
l AS (SELECT m, c, b0, b1, b2, sign(b0) AS s0, sign(b1) AS s1, sign(b2) AS s2 FROM n{_NEWTON}),
{','.join(_newton(_NEWTON + k + 1, f'n{_NEWTON + k}' if k else 'l', 0, _SIGNS) for k in range(_NEWTON))}
{' UNION ALL '.join(f"SELECT m AS without_fold, '{name}' AS penalty, c, {i} AS place, round(b{i}, 6) AS value FROM n{k}" for name, k in (('l2', _NEWTON), ('l1', 2 * _NEWTON)) for i in range(3))}"""

ORACLES["report_sections"] = f"""
WITH {APPS}, t AS (SELECT fraud_bool, count(*) AS n, count(*) * 100e0 / sum(count(*)) OVER () AS pct FROM apps GROUP BY 1),
m AS (SELECT month, count(*) AS n, CAST(sum(fraud_bool) AS BIGINT) AS pos, sum(fraud_bool) * 1e0 / count(*) AS pos_rate
  FROM apps WHERE month IS NOT NULL GROUP BY 1)
SELECT 'target' AS section, CAST(fraud_bool AS VARCHAR) AS key, 'n' AS name, CAST(n AS VARCHAR) AS value FROM t
UNION ALL SELECT 'target', CAST(fraud_bool AS VARCHAR), 'pct', CAST(pct AS VARCHAR) FROM t
UNION ALL SELECT 'monthly', CAST(month AS VARCHAR), 'n', CAST(n AS VARCHAR) FROM m
UNION ALL SELECT 'monthly', CAST(month AS VARCHAR), 'pos', CAST(pos AS VARCHAR) FROM m
UNION ALL SELECT 'monthly', CAST(month AS VARCHAR), 'pos_rate', CAST(pos_rate AS VARCHAR) FROM m"""
