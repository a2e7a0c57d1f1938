"""SQL building blocks of the comparison queries (DuckDB dialect)."""

from __future__ import annotations

import re

from tallyfold.functions.tails import DE_FIRST, DE_LAST, DE_STEP
from tallyfold.plans import summary as text
from tallyfold.study import METADATA, TIME
from verification.star import LEADING, STAR

COMPONENTS = STAR.components
META = ", ".join(METADATA)


def rank(column: str, order=COMPONENTS) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {i}" for i, name in enumerate(order, 1))
    return f"CAST(CASE {column} {cases} END AS INTEGER)"


def in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def r(expression: str, digits: int = 6) -> str:
    """Rounded double without a negative zero."""
    return f"(round(CAST({expression} AS DOUBLE), {digits}) + 0.0::DOUBLE)"


def _piece(name: str) -> str:
    flag, status = name.split("_")
    return (f"CAST(sum(CASE WHEN l_returnflag = '{flag}' AND l_linestatus = '{status}' "
            f"THEN l_quantity ELSE 0 END) AS BIGINT) AS {name}")


SUBJECTS = """people AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS subject, n_name AS project,
    c_mktsegment AS condition, CAST(c_custkey % 50 + 20 AS INTEGER) AS age,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN 'none' WHEN c_custkey % 3 = 0 THEN 'phauximab'
         ELSE 'miraclib' END AS treatment,
    CASE WHEN c_mktsegment = 'FURNITURE' OR c_custkey % 7 = 0 THEN NULL
         WHEN c_acctbal >= 4500 THEN 'yes' ELSE 'no' END AS response
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
SAMPLES = f"""taken AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderkey AS VARCHAR) AS sample,
    CASE WHEN o_orderstatus = 'F' THEN 'WB' ELSE 'PBMC' END AS sample_type,
    CAST(o_orderkey % 3 * 7 AS INTEGER) AS {TIME}
  FROM orders)"""
METADATA_CTE = f"""meta AS (
  SELECT o_orderkey, {META} FROM taken JOIN people ON o_custkey = c_custkey)"""
_COUNTS = ", ".join(_piece(c) for c in COMPONENTS)
_FILLED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in COMPONENTS)
_TOTAL = " + ".join(COMPONENTS)
_LONG = " UNION ALL ".join(
    f"SELECT {META}, total_count, '{c}' AS population, {c} AS count FROM totalled"
    for c in COMPONENTS)
WIDE = f"""line AS (SELECT l_orderkey, {_COUNTS} FROM lineitem GROUP BY l_orderkey),
wide AS (SELECT {META}, {_FILLED} FROM meta LEFT JOIN line ON o_orderkey = l_orderkey)"""
BASE = f"WITH {SUBJECTS}, {SAMPLES}, {METADATA_CTE}, {WIDE}"
LONG = f"""totalled AS (SELECT *, CAST({_TOTAL} AS BIGINT) AS total_count FROM wide),
long AS (SELECT *, CASE WHEN total_count = 0 THEN 0.0::DOUBLE
  ELSE count::DOUBLE / total_count::DOUBLE * 100 END AS percentage FROM ({_LONG}))"""
FREQUENCIES = f"{BASE}, {LONG}"
_COHORT = " AND ".join(f"{k} = '{v}'" for k, v in STAR.cohort.items())
COHORT = f"{FREQUENCIES}, cohort AS (SELECT * FROM long WHERE {_COHORT} AND response IN ('yes', 'no'))"
BASELINE = (f"WITH {SUBJECTS}, {SAMPLES}, {METADATA_CTE}, "
            f"baseline AS (SELECT * FROM meta WHERE {_COHORT} AND {TIME} = 0)")
FILLED = f"{BASE}, filled AS (SELECT * FROM wide WHERE {_TOTAL} > 0)"


def _nodes(height: str) -> str:
    """Double-exponential sum of a decaying integrand over y from 0 to infinity."""
    y = f"exp(k * {DE_STEP}::DOUBLE - exp(-k * {DE_STEP}::DOUBLE))"
    return (f"({DE_STEP}::DOUBLE * list_sum(list_transform(range({DE_FIRST}, {DE_LAST + 1}), "
            f"lambda k: {height.replace('@y', y)} * {y} * (1 + exp(-k * {DE_STEP}::DOUBLE)))))")


def normal_sf(z: str) -> str:
    upper = (f"(exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * "
             + _nodes(f"exp(-abs({z}) * (@y) - (@y) * (@y) / 2)") + ")")
    return f"(CASE WHEN {z} >= 0 THEN {upper} ELSE 1 - {upper} END)"


def _sech_tail(start: str, df: str) -> str:
    scale = f"(1 / (sqrt({df}) + ({df}) * tanh({start})))"
    log_cosh = "(0.5::DOUBLE * ln(1 + sinh({0}) * sinh({0})))"
    at, floor = log_cosh.format(f"({start} + {scale} * (@y))"), log_cosh.format(f"({start})")
    return f"({scale} * " + _nodes(f"exp(-({df}) * ({at} - {floor}))") + ")"


def student_t(t: str, df: str) -> str:
    start = f"asinh(abs({t}) / sqrt({df}))"
    front = f"exp(-({df}) * 0.5::DOUBLE * ln(1 + sinh({start}) * sinh({start})))"
    return (f"least(1.0::DOUBLE, {front} * {_sech_tail(start, df)} / "
            f"{_sech_tail('0.0::DOUBLE', df)})")


def comparison(source: str, keys: str, group: str, value: str, a: str, b: str) -> str:
    """CTEs ending in ``compared``: one row per key with every two-group statistic."""
    k = keys
    on = " AND ".join(f"h.{x.strip()} = g.{x.strip()}" for x in keys.split(","))
    return f"""picked AS (
  SELECT {k}, CAST({value} AS DOUBLE) AS v, {group} = '{a}' AS is_a FROM {source}
  WHERE {group} IN ('{a}', '{b}')),
hist AS (
  SELECT {k}, v, count(*) FILTER (is_a) AS na, count(*) FILTER (NOT is_a) AS nb
  FROM picked GROUP BY ALL),
cumulated AS (
  SELECT *, sum(nb) OVER (PARTITION BY {k} ORDER BY v) - nb AS below_b FROM hist),
ranks AS (
  SELECT {k}, CAST(sum(na * (2 * below_b + nb)) AS DOUBLE) AS u_doubled,
    CAST(sum((na + nb) * (na + nb) * (na + nb) - (na + nb)) AS DOUBLE) AS tie_sum
  FROM cumulated GROUP BY {k}),
moments AS (
  SELECT {k}, count(*) FILTER (is_a) AS n_a, count(*) FILTER (NOT is_a) AS n_b,
    median(v) FILTER (is_a) AS median_a, median(v) FILTER (NOT is_a) AS median_b,
    avg(v) FILTER (is_a) AS mean_a, avg(v) FILTER (NOT is_a) AS mean_b,
    var_samp(v) FILTER (is_a) / count(*) FILTER (is_a) AS sa,
    var_samp(v) FILTER (NOT is_a) / count(*) FILTER (NOT is_a) AS sb
  FROM picked GROUP BY {k}),
basics AS (
  SELECT g.*, u_doubled, tie_sum, u_doubled / 2 AS mwu_stat,
    (mean_a - mean_b) / sqrt(sa + sb) AS t_stat,
    (sa + sb) * (sa + sb) / (sa * sa / (n_a - 1) + sb * sb / (n_b - 1)) AS t_df,
    n_a::DOUBLE * n_b AS pairs, (n_a + n_b)::DOUBLE AS n
  FROM moments g JOIN ranks h ON {on}),
deviates AS (
  SELECT *, (greatest(mwu_stat, pairs - mwu_stat) - pairs / 2 - 0.5::DOUBLE)
    / sqrt(pairs / 12 * (n + 1 - tie_sum / (n * (n - 1)))) AS z FROM basics),
compared AS (
  SELECT *, {student_t('t_stat', 't_df')} AS t_p_raw,
    least(1.0::DOUBLE, 2 * {normal_sf('z')}) AS mwu_p_raw,
    2 * mwu_stat / pairs - 1 AS rank_biserial,
    mean_a - mean_b AS mean_difference, median_a - median_b AS median_difference
  FROM deviates)"""


def adjusted(p: str, name: str, source: str, target: str, family: str) -> str:
    """CTE adding the Benjamini-Hochberg column ``name`` of ``p``."""
    return f"""{target}_scaled AS (
  SELECT *, {p} / (row_number() OVER (PARTITION BY {family} ORDER BY {p})::DOUBLE
    / count(*) OVER (PARTITION BY {family})::DOUBLE) AS scaled FROM {source}),
{target} AS (
  SELECT * EXCLUDE (scaled), least(1.0::DOUBLE, min(scaled) OVER (
    PARTITION BY {family} ORDER BY {p} DESC, scaled ROWS UNBOUNDED PRECEDING)) AS {name}
  FROM {target}_scaled)"""


# The second study (star.SHIFTED): a component's share decides the response.
SHIFTED_COHORT = f"""{FREQUENCIES}, cohort AS (
  SELECT * REPLACE (CASE WHEN sample IN (SELECT sample FROM wide WHERE 3 * {LEADING} > {_TOTAL})
    THEN 'yes' ELSE 'no' END AS response) FROM long
  WHERE condition = 'BUILDING' AND treatment = 'miraclib')"""


_DOUBLES = ("median_responder", "median_nonresponder", "mean_responder", "mean_nonresponder",
            "mean_difference", "median_difference", "rank_biserial", "t_stat", "t_p_raw",
            "t_p_bh", "mwu_stat", "mwu_p_raw", "mwu_p_bh")
_NAMES = {"median_responder": "median_a", "median_nonresponder": "median_b",
          "mean_responder": "mean_a", "mean_nonresponder": "mean_b"}
STATS_SELECT = ", ".join(
    ["population", "n_a AS n_responder", "n_b AS n_nonresponder"]
    + [f"{r(_NAMES.get(c, c))} AS {c}" for c in _DOUBLES]
    + ["mwu_p_bh < 0.05 AS significant_primary",
       "t_p_bh < 0.05 AND mwu_p_bh < 0.05 AS significant_high_confidence"])
def stats(cohort: str) -> str:
    """CTEs ending in ``stats`` of the rows of ``cohort``."""
    return f"""{cohort}, scoped AS (
  SELECT *, 'pooled' AS scope FROM cohort UNION ALL
  SELECT *, 't=' || {TIME} AS scope FROM cohort WHERE {TIME} IN (0, 7, 14)),
{comparison('scoped', 'scope, population', 'response', 'percentage', 'yes', 'no')},
{adjusted('t_p_raw', 't_p_bh', 'compared', 'first_adjusted', 'scope')},
{adjusted('mwu_p_raw', 'mwu_p_bh', 'first_adjusted', 'both_adjusted', 'scope')},
stats AS (
  SELECT scope, TRY_CAST(regexp_extract(scope, 't=(.*)', 1) AS INTEGER) AS timepoint,
    {STATS_SELECT} FROM both_adjusted UNION ALL
  SELECT 'baseline' AS scope, NULL AS timepoint, {STATS_SELECT} FROM both_adjusted
  WHERE scope = 't=0')"""


def on_filled(text: str) -> str:
    """The same over the samples that the loader accepts: a total above zero."""
    assert "AS total_count FROM wide)" in text
    return text.replace("AS total_count FROM wide)", f"AS total_count FROM wide WHERE {_TOTAL} > 0)")


STATS = stats(COHORT)
SHIFTED_STATS = stats(SHIFTED_COHORT)


def boxes(source: str, keys: str) -> str:
    """CTEs ``fences`` and ``boxes`` of the ``percentage`` per key."""
    on = " AND ".join(f"s.{x.strip()} = f.{x.strip()}" for x in keys.split(","))
    named = ", ".join(f"f.{x.strip()}" for x in keys.split(","))
    return f"""quartiles AS (
  SELECT {keys}, count(*) AS n, quantile_cont(percentage, 0.25) AS q1,
    quantile_cont(percentage, 0.5) AS median, quantile_cont(percentage, 0.75) AS q3
  FROM {source} GROUP BY {keys}),
fences AS (
  SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS low, q3 + 1.5::DOUBLE * (q3 - q1) AS high
  FROM quartiles),
boxes AS (
  SELECT {named}, f.n, f.q1, f.median, f.q3,
    least(min(percentage) FILTER (percentage >= low), any_value(f.q1)) AS whisker_low,
    greatest(max(percentage) FILTER (percentage <= high), any_value(f.q3)) AS whisker_high,
    count(*) FILTER (percentage < low OR percentage > high) AS n_outliers
  FROM {source} s JOIN fences f ON {on}
  GROUP BY {named}, f.n, f.q1, f.median, f.q3)"""


LABELLED = f"""{COHORT}, labelled AS (
  SELECT *, CASE response WHEN 'yes' THEN 'Responder' WHEN 'no' THEN 'Non-responder' END
    AS response_label FROM cohort)"""


def _fill(template: str, **columns: str) -> str:
    """SQL of a text with {name} places: format pieces joined with SQL expressions."""
    pieces = re.split(r"{(\w+)(?::[^}]*)?}", template)
    return "concat(" + ", ".join(
        columns[piece] if i % 2 else "'" + piece.replace("'", "''") + "'"
        for i, piece in enumerate(pieces)) + ")"


def _shown(**digits: str) -> dict[str, str]:
    return {name: f"printf('{form}', {name})" for name, form in digits.items()}


def summary_lines(study) -> str:
    """Select the lines of the summary text after the CTEs of ``stats``: from the unrounded statistics
    and the cohort's samples."""
    facts = {name: "'" + (f"{value:g}" if isinstance(value, float) else str(value)) + "'"
             for name, value in text.study_facts(study).items()}
    sizes = {"subjects": "(SELECT count(DISTINCT subject) FROM samples WHERE {})",
             "samples": "(SELECT count(*) FROM samples WHERE {})"}
    first, every = f"{TIME} = {study.baseline}", "true"
    each = [sizes["samples"].format(f"{TIME} = {time}") for time in study.timepoints]
    per_time = (f"CASE WHEN {' AND '.join(f'{each[0]} = {x}' for x in each)} THEN "
                f"concat({each[0]}, ' each') ELSE concat_ws(', ', {', '.join(each)}) END")
    effects = _shown(mwu_p_bh="%.4g", rank_biserial="%.3f", median_difference="%.3f")

    def findings(scope: str, template: str, none: str, order: str = "") -> str:
        line = _fill(template, population="population", timepoint="substring(scope, 3)", **effects)
        return (f"coalesce((SELECT string_agg({line}, chr(10) ORDER BY {order}"
                f"{rank('population', study.components)}) FROM both_adjusted WHERE {scope} "
                f"AND mwu_p_bh < {study.alpha}), {_fill(none, **facts)})")

    both = (f"(SELECT string_agg(population, ', ' ORDER BY {rank('population', study.components)}) "
            f"FROM both_adjusted WHERE scope = 't={study.baseline}' AND mwu_p_bh < {study.alpha} "
            f"AND t_p_bh < {study.alpha})")
    sections = [
        [_fill(text.BASELINE_HEADING, **facts, subjects=sizes["subjects"].format(first)),
         _fill(text.BASELINE_ABOUT, **facts),
         findings(f"scope = 't={study.baseline}'", text.BASELINE_LINE, text.BASELINE_NONE)],
        [_fill(text.POOLED_HEADING, **facts, samples=sizes["samples"].format(every),
               subjects=sizes["subjects"].format(every)),
         _fill(text.POOLED_ABOUT, **facts),
         findings("scope = 'pooled'", text.POOLED_LINE, text.POOLED_NONE)],
        [_fill(text.TIMEPOINT_HEADING, sizes=per_time,
               timepoints="'" + ", ".join(map(str, study.timepoints)) + "'"),
         _fill(text.TIMEPOINT_ABOUT, **facts),
         findings("scope <> 'pooled'", text.TIMEPOINT_LINE, text.TIMEPOINT_NONE,
                  "CAST(substring(scope, 3) AS INTEGER), ")],
        [f"'{text.CROSSCHECK_HEADING}'",
         f"CASE WHEN {both} IS NULL THEN {_fill(text.CROSSCHECK_NONE, **facts)} ELSE "
         f"{_fill(text.CROSSCHECK_SOME, **facts, names=both)} END"],
    ]
    whole = " || chr(10) || chr(10) || '---' || chr(10) || chr(10) || ".join(
        " || chr(10) || chr(10) || ".join(section) for section in sections)
    return f"""WITH samples AS (SELECT DISTINCT sample, subject, {TIME} FROM cohort),
whole AS (SELECT string_split({whole}, chr(10)) AS lines)
SELECT CAST(unnest(range(1, len(lines) + 1)) AS INTEGER) AS line_no, unnest(lines) AS line
FROM whole"""


def summary(stats_sql: str, study) -> str:
    """The lines of the summary text, numbered."""
    return f"{stats_sql} SELECT * FROM ({summary_lines(study)})"
