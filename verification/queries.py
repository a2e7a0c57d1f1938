"""Every registered query with, where there is one, the SQL giving the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.functions.scalars import component_rank, fixed_decimals
from tallyfold.functions.tails import normal_sf, student_t_two_sided
from tallyfold.operators import checks, cohort as cohorts, explore as views, normalize as norm
from tallyfold.operators.boxplot import (
    annotate, boxes_of_ranks, boxplot_input, formatted_stats, study_boxes)
from tallyfold.operators.compare import (
    compare_scopes, one_scope, per_timepoint, scope_ranks,
    scope_statistics as statistics_of_ranks, stats_order, tag_scopes,
    two_group_compare)
from tallyfold.operators.composition import composition_of_events, composition_of_wide
from tallyfold.operators.fdr import bh_adjust, bh_adjust_families, flagged
from tallyfold.operators.ranks import ranked_histogram
from tallyfold.operators.skew import spread
from tallyfold.plans.jobs import (
    analyse, cohort_frequencies, load, ordered_frequencies, table_frequencies)
from tallyfold.plans.summary import significance_summary
from tallyfold.sources import tables as store
from tallyfold.sources.wide_csv import (
    MALFORMED, UNCASTABLE, InvalidInput, column_differences, read_wide, type_wide)
from tallyfold.study import COHORT_COLUMNS, METADATA, STATS_COLUMNS, TABLES, TIME
from verification import sql, star
from verification.star import LINES, STAR

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FREQUENCY = ("sample", "total_count", "population", "count", "percentage")
EVENT_TYPES = ("view", "click", "signup", "purchase", "error")


def query(oracle: str | None = None):
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with store.scope(spark) as scope:  # what the query stages goes when its result is written
                return scope.keep(function(spark, sf_dir))

        QUERIES[function.__name__] = run
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return run
    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, without a negative zero: distributed sums differ in the last bits."""
    return df.selectExpr(*[
        f"round(`{name}`, {digits}) + 0D AS `{name}`" if kind == "double" else f"`{name}`"
        for name, kind in df.dtypes])


def ranked(df: DataFrame) -> DataFrame:
    return df.withColumn("component_rank", component_rank(F.col("population"), STAR.components))


FREQUENCY_SQL = (f"sample, total_count, population, count, {sql.r('percentage')} AS percentage")
RANK_SQL = f"{sql.rank('population')} AS component_rank"


# --- composition --------------------------------------------------------------------------


@query(f"""WITH counted AS (
  SELECT user_id, event_type, count(*) AS count FROM events GROUP BY user_id, event_type),
totals AS (SELECT *, CAST(sum(count) OVER (PARTITION BY user_id) AS BIGINT) AS total_count
  FROM counted)
SELECT user_id, total_count, event_type, count,
  {sql.r('CASE WHEN total_count = 0 THEN 0 ELSE count::DOUBLE / total_count::DOUBLE * 100 END')}
    AS percentage,
  {sql.rank('event_type', EVENT_TYPES)} AS component_rank FROM totals""")
def event_composition(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    return rounded(composition_of_events(events, "user_id", "event_type")).withColumn(
        "component_rank", component_rank(F.col("event_type"), EVENT_TYPES))


@query(f"{sql.FREQUENCIES} SELECT {FREQUENCY_SQL}, {RANK_SQL} FROM long")
def relative_frequencies(spark, sf_dir):
    return ranked(rounded(ordered_frequencies(star.tables(spark, sf_dir), STAR)))


@query(f"{sql.FREQUENCIES} SELECT {FREQUENCY_SQL} FROM long")
def wide_frequencies(spark, sf_dir):
    return rounded(composition_of_wide(star.wide(spark, sf_dir), STAR.components))


@query(f"{sql.FREQUENCIES} SELECT {FREQUENCY_SQL}, {sql.META.replace('sample, ', '', 1)} FROM long")
def frequencies_with_metadata(spark, sf_dir):
    tables = star.tables(spark, sf_dir)
    joined = norm.with_metadata(table_frequencies(tables, STAR), norm.sample_metadata(tables))
    return rounded(joined)


@query(f"{sql.FREQUENCIES} SELECT {FREQUENCY_SQL} FROM long")
def frequency_csv(spark, sf_dir):
    path = store.working_dir(spark)
    frequencies = ordered_frequencies(star.tables(spark, sf_dir), STAR)
    store.write_table(frequencies, path, "csv")
    return rounded(store.read_optional(spark, path, "csv", frequencies.schema))


# --- input and tables ---------------------------------------------------------------------


WIDE_SQL = f"{sql.BASE} SELECT {sql.META}, {', '.join(STAR.components)} FROM wide"


@query(WIDE_SQL)
def wide_input(spark, sf_dir):
    return star.wide(spark, sf_dir)


@query(f"""{sql.BASE} SELECT sample, project || chr(10) || '"' || subject || '",' || chr(10) || '.' AS project,
  {", ".join(c for c in METADATA if c not in ("sample", "project"))}, {", ".join(STAR.components)}
FROM wide""")
def quoted_line_breaks(spark, sf_dir):
    """A field with line breaks, quotes and a comma in every record, read by blocks of the files."""
    path = store.working_dir(spark)
    project = F.concat("project", F.lit('\n"'), "subject", F.lit('",\n.'))
    store.write_table(star.wide(spark, sf_dir).withColumn("project", project), path, "csv")
    return read_wide(spark, path, STAR).drop(UNCASTABLE, MALFORMED)


@query(WIDE_SQL)
def wide_csv_scan(spark, sf_dir):
    """Written with its columns in another order, then read back by name."""
    path = store.working_dir(spark)
    wide = star.wide(spark, sf_dir)
    store.write_table(wide.select(*reversed(wide.columns)), path, "csv")
    return read_wide(spark, path, STAR).drop(UNCASTABLE, MALFORMED)


@query(f"{sql.BASE} SELECT DISTINCT project AS project_id FROM wide")
def project_table(spark, sf_dir):
    return norm.normalize(star.wide(spark, sf_dir), STAR)["projects"]


@query(f"""{sql.BASE} SELECT subject AS subject_id, project AS project_id, condition, age, sex,
  treatment, response FROM wide
QUALIFY row_number() OVER (PARTITION BY subject ORDER BY {TIME}, sample) = 1""")
def subject_table(spark, sf_dir):
    return norm.normalize(star.wide(spark, sf_dir), STAR)["subjects"]


@query(f"""{sql.BASE} SELECT sample AS sample_id, subject AS subject_id, sample_type, {TIME}
FROM wide""")
def sample_table(spark, sf_dir):
    return norm.normalize(star.wide(spark, sf_dir), STAR)["samples"]


@query(f"{sql.FREQUENCIES} SELECT sample AS sample_id, population, count FROM long")
def count_table(spark, sf_dir):
    return norm.normalize(star.wide(spark, sf_dir), STAR)["cell_counts"]


def _contents(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, row) of every row of every table, doubles as rounded millionths."""
    out = None
    for name, df in tables.items():
        cells = [F.round(F.col(c) * 1e6).cast("bigint").cast("string") if kind == "double"
                 else F.col(c).cast("string") for c, kind in sorted(df.dtypes)]
        part = df.select(F.lit(name).alias("name"), F.concat_ws(
            "|", *[F.coalesce(c, F.lit("NULL")) for c in cells]).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


def _contents_sql(**tables: tuple[str, str]) -> str:
    """The same from (columns, source) pairs; columns: ``name`` or ``name:double``, in any order."""
    def cell(column: str) -> str:
        name, _, kind = column.partition(":")
        value = f"CAST(round({name} * 1e6) AS BIGINT)" if kind else name
        return f"coalesce(CAST({value} AS VARCHAR), 'NULL')"

    return " UNION ALL ".join(
        f"SELECT '{name}' AS name, concat_ws('|', "
        f"{', '.join(cell(c) for c in sorted(columns.split()))}) AS row FROM {source}"
        for name, (columns, source) in tables.items())


_LONG_FILLED = "(" + " UNION ALL ".join(
    f"SELECT sample AS sample_id, '{c}' AS population, {c} AS count FROM filled"
    for c in STAR.components) + ")"
TABLE_CONTENTS = f"{sql.FILLED} " + _contents_sql(
    projects=("project_id", "(SELECT DISTINCT project AS project_id FROM filled)"),
    subjects=("subject_id project_id condition age sex treatment response",
              "(SELECT DISTINCT subject AS subject_id, project AS project_id, condition, age, sex, "
              "treatment, response FROM filled)"),
    samples=(f"sample_id subject_id sample_type {TIME}",
             "(SELECT sample AS sample_id, subject AS subject_id, * FROM filled)"),
    cell_counts=("sample_id population count", _LONG_FILLED))


def _loaded(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    path = store.working_dir(spark)
    store.write_table(star.filled_wide(spark, sf_dir), f"{path}/input", "csv")
    return load(spark, f"{path}/input", store.shared_dir(spark), STAR)


@query(TABLE_CONTENTS)
def load_tables(spark, sf_dir):
    """CSV to validated, published tables: all their rows."""
    made = _loaded(spark, sf_dir)
    return _contents({name: made[name] for name in TABLES})


@query(TABLE_CONTENTS)
def rebuild_tables(spark, sf_dir):
    """Two runs over the same folder: the second one is the published one, rows unchanged. The wide rows
    are stored once, as the load job does."""
    path = store.working_dir(spark)
    made = norm.normalize(store.staged(star.filled_wide(spark, sf_dir), "wide"), STAR)
    for _ in range(2):
        run, folder = store.new_run(path)
        store.write_tables(made, folder)
        store.publish(spark, path, run)
    return _contents(store.read_tables(spark, store.published_run(spark, path)))


@query("SELECT 'zero_total' AS rule, count(*) AS n FROM ("
       f"{sql.BASE} SELECT * FROM wide WHERE {' + '.join(STAR.components)} = 0)")
def refused_load(spark, sf_dir):
    """The load of all samples, zero totals included, is refused; the findings say why."""
    path = store.working_dir(spark)
    store.write_table(star.wide(spark, sf_dir), f"{path}/input", "csv")
    try:
        load(spark, f"{path}/input", path, STAR)
    except InvalidInput:
        found = checks.violations(spread(read_wide(spark, f"{path}/input", STAR)), STAR)
        return found.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    raise AssertionError("the load was not refused")


# --- checks -------------------------------------------------------------------------------


_LINE = "concat_ws('-', l_orderkey, l_linenumber)"
_GAP = "CAST(round(l_extendedprice * (l_discount - 0.05::DOUBLE), 0) AS BIGINT)"
_TAX = "CAST(round(l_tax * 100, 0) AS BIGINT)"


def _row_rule(no: int, rule: str, column: str, detail: str, condition: str, major: int = 0) -> str:
    return (f"SELECT {no + 1} AS rule_no, {major} AS major, '{rule}' AS rule, {_LINE} AS key, "
            f"{column} AS col, {detail} AS detail, 0 AS minor FROM lineitem WHERE {condition}")


def _drift_rule(column: str, expression: str, minor: int) -> str:
    return (f"SELECT 4 AS rule_no, 0 AS major, 'subject_drift' AS rule, "
            f"CAST(l_orderkey AS VARCHAR) AS key, '{column}' AS col, NULL AS detail, "
            f"{minor} AS minor FROM lineitem GROUP BY l_orderkey "
            f"HAVING count(DISTINCT {expression}) > 1")


FINDINGS = "WITH found AS (" + " UNION ALL ".join([
    f"SELECT 1 AS rule_no, 0 AS major, 'duplicate_sample' AS rule, {_LINE} AS key, "
    "'sample' AS col, CAST(count(*) AS VARCHAR) AS detail, 0 AS minor FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    _row_rule(1, "negative_count", "'price_gap'", f"CAST({_GAP} AS VARCHAR)", f"{_GAP} < 0"),
    _row_rule(2, "zero_total", "NULL", "NULL", f"{_GAP} + {_TAX} = 0"),
    _drift_rule("project", "l_linestatus", 0),
    _drift_rule("condition", "l_returnflag", 1),
    _drift_rule("sex", "l_suppkey % 2", 2),
    _drift_rule("response", "l_partkey % 3", 4),
    _drift_rule("age", "CASE WHEN l_quantity < 49 THEN l_quantity END", 5),
    _row_rule(4, "not_integer", "'age'", "NULL", "l_quantity >= 49"),
]) + ")"


def _findings(spark, sf_dir) -> DataFrame:
    """Typed once into a table that all rules read, as the load job does."""
    path = store.working_dir(spark)
    typed = type_wide(star.faulty_text(spark, sf_dir), LINES)
    store.write_table(typed, path)
    return checks.violations(spread(spark.read.schema(typed.schema).parquet(path)), LINES)


@query(f"""SELECT {_LINE} AS key, CASE l_partkey % 97 WHEN 0 THEN 13 ELSE 11 END AS fields
FROM lineitem WHERE l_partkey % 97 IN (0, 1)""")
def malformed_rows(spark, sf_dir):
    """Records with a surplus or a missing field, found in the text by the CSV scan."""
    path = store.working_dir(spark)
    star.malformed_csv(spark, sf_dir, path)
    found = checks.violations(spread(read_wide(spark, path, LINES)), LINES)
    return found.where("rule = 'malformed_row'").select(
        "key", F.size(F.split("detail", ",")).alias("fields"))


@query(f"""SELECT 'missing' AS kind, name FROM (VALUES {", ".join(f"('{c}')" for c in
  LINES.wide_columns)}) v(name) UNION ALL
SELECT 'unexpected', column_name FROM (DESCRIBE lineitem)""")
def column_contract(spark, sf_dir):
    """The raw line items against the wide input's column set."""
    missing, unexpected = column_differences(star.table(spark, sf_dir, "lineitem").columns, LINES)
    rows = [("missing", c) for c in missing] + [("unexpected", c) for c in unexpected]
    return spark.createDataFrame(rows, "kind string, name string")


@query(f"{FINDINGS} SELECT rule, key, col AS \"column\", detail FROM found")
def input_violations(spark, sf_dir):
    return _findings(spark, sf_dir).select(*checks.VIOLATION_COLUMNS)


@query(f"""{FINDINGS} SELECT rule, key, col AS "column", detail FROM found
ORDER BY rule_no, major, key, minor LIMIT 1""")
def first_violation(spark, sf_dir):
    """The report of one violation: a top-1 by rule, then key."""
    found = _findings(spark, sf_dir)
    return found.orderBy(*checks.report_order()).limit(1).select(*checks.VIOLATION_COLUMNS)


@query(f"""{sql.BASE}
SELECT 'zero_total' AS rule, sample AS key, NULL::VARCHAR AS "column", NULL::VARCHAR AS detail
FROM wide WHERE {' + '.join(STAR.components)} = 0""")
def wide_violations(spark, sf_dir):
    return checks.violations(star.wide(spark, sf_dir), STAR).select(*checks.VIOLATION_COLUMNS)


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def repeated_keys(spark, sf_dir):
    return checks.duplicate_keys(star.table(spark, sf_dir, "lineitem"),
                                 ["l_orderkey", "l_linenumber"])


@query(" UNION ALL ".join(
    f"SELECT o_custkey, '{c}' AS \"column\" FROM orders GROUP BY o_custkey "
    f"HAVING count(DISTINCT {c}) > 1" for c in ("o_orderstatus", "o_orderpriority")))
def drifting_attributes(spark, sf_dir):
    return checks.drift(star.table(spark, sf_dir, "orders"), "o_custkey",
                        ["o_orderstatus", "o_orderpriority"]).select("o_custkey", "column")


@query("""SELECT doc_id, count(*) AS n FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""")
def orphan_rows(spark, sf_dir):
    return checks.orphans(star.table(spark, sf_dir, "documents"), "doc_id",
                          star.table(spark, sf_dir, "labels").select("doc_id").distinct(),
                          "doc_id")


@query(f"""{sql.BASE} SELECT 'response' AS "column", count(*) AS n FROM wide
WHERE response IS NULL""")
def missing_values(spark, sf_dir):
    return checks.missing_values(star.wide(spark, sf_dir), list(METADATA))


@query(f"""SELECT 'cell_counts' AS "table", 'duplicate_key' AS rule,
  concat_ws('|', l_orderkey, l_returnflag || '_' || l_linestatus) AS key, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_returnflag, l_linestatus HAVING count(*) > 1""")
def table_violations(spark, sf_dir):
    """The star's tables with line quantities not yet summed per component."""
    line = star.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("sample_id"),
        F.concat_ws("_", "l_returnflag", "l_linestatus").alias("population"),
        F.col("l_quantity").cast("bigint").alias("count"))
    return checks.table_violations({**star.tables(spark, sf_dir), "cell_counts": line})


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def negative_values(spark, sf_dir):
    balances = star.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return checks.negative_counts(balances, "c_acctbal")


@query(f"""SELECT l_orderkey, count(*) AS n FROM (
  SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem)
GROUP BY l_orderkey HAVING count(*) <> {len(STAR.components)}""")
def incomplete_samples(spark, sf_dir):
    used = star.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus").distinct()
    return checks.incomplete_entities(used, "l_orderkey", len(STAR.components))


@query(f"""{sql.FREQUENCIES} SELECT sample, {sql.r('sum(percentage)')} AS percentage_sum
FROM long GROUP BY sample HAVING abs(sum(percentage) - 100) >= 1e-6""")
def open_compositions(spark, sf_dir):
    frequencies = composition_of_wide(star.wide(spark, sf_dir), STAR.components)
    return rounded(checks.open_compositions(frequencies))


@query("""SELECT 'unexpected' AS finding, event_type FROM (SELECT DISTINCT event_type FROM events)
WHERE event_type NOT IN ('view', 'click', 'refund') UNION ALL
SELECT 'absent', 'refund' WHERE 'refund' NOT IN (SELECT event_type FROM events)""")
def vocabulary_check(spark, sf_dir):
    events, expected = star.table(spark, sf_dir, "events"), ["view", "click", "refund"]
    return (checks.unexpected_values(events, "event_type", expected)
            .select(F.lit("unexpected").alias("finding"), "event_type")
            .unionByName(checks.absent_values(events, "event_type", expected)
                         .select(F.lit("absent").alias("finding"), "event_type")))


@query(f"""{sql.FREQUENCIES} SELECT count(*) AS n_facts, count(*) AS n_joined, true AS complete
FROM long""")
def join_check(spark, sf_dir):
    tables = star.tables(spark, sf_dir)
    frequencies = table_frequencies(tables, STAR)
    joined = norm.with_metadata(frequencies, norm.sample_metadata(tables))
    return checks.join_cardinality(frequencies, joined)


# --- metadata and cohorts -----------------------------------------------------------------


@query(f"WITH {sql.SUBJECTS}, {sql.SAMPLES}, {sql.METADATA_CTE} SELECT {sql.META} FROM meta")
def sample_metadata(spark, sf_dir):
    return norm.sample_metadata(star.tables(spark, sf_dir))


@query(f"{sql.COHORT} SELECT {FREQUENCY_SQL}, subject, response, {TIME} FROM cohort")
def comparison_cohort(spark, sf_dir):
    return rounded(star.cohort(spark, sf_dir).select(*FREQUENCY, "subject", "response", TIME))


@query(f"{sql.COHORT} SELECT {FREQUENCY_SQL}, subject, response, {TIME} FROM cohort")
def comparison_cohort_of_tables(spark, sf_dir):
    """The same rows from the normalised tables."""
    found = cohort_frequencies(star.tables(spark, sf_dir), STAR)
    return rounded(found.select(*FREQUENCY, "subject", "response", TIME))


@query(f"{sql.COHORT} SELECT {FREQUENCY_SQL}, response FROM cohort WHERE {TIME} = 0")
def comparison_cohort_baseline(spark, sf_dir):
    at_start = star.cohort(spark, sf_dir).where(F.col(TIME) == STAR.baseline)
    return rounded(at_start.select(*FREQUENCY, "response"))


@query(f"""{sql.COHORT}, scoped AS (
  SELECT *, 'pooled' AS scope FROM cohort UNION ALL
  SELECT *, 't=' || {TIME} AS scope FROM cohort WHERE {TIME} IN (0, 7, 14))
SELECT scope, population, response, count(*) AS n FROM scoped GROUP BY ALL""")
def scope_sizes(spark, sf_dir):
    tagged = tag_scopes(star.cohort(spark, sf_dir), STAR.timepoints)
    return tagged.groupBy("scope", "population", "response").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{sql.COHORT}, once AS (
  SELECT DISTINCT sample, subject, response, {TIME} FROM cohort), scoped AS (
  SELECT *, 'pooled' AS scope FROM once UNION ALL
  SELECT *, 't=' || {TIME} AS scope FROM once WHERE {TIME} IN (0, 7, 14))
SELECT scope, count(*) AS n_samples, count(DISTINCT subject) AS n_subjects,
  count(DISTINCT subject) FILTER (response = 'yes') AS n_responder_subjects,
  count(DISTINCT subject) FILTER (response = 'no') AS n_nonresponder_subjects
FROM scoped GROUP BY scope""")
def cohort_profile(spark, sf_dir):
    chosen = cohorts.comparison_cohort(star.metadata(spark, sf_dir), STAR)
    return cohorts.cohort_profile(chosen, STAR)


@query(f"{sql.BASELINE} SELECT {', '.join(COHORT_COLUMNS)} FROM baseline")
def baseline_cohort(spark, sf_dir):
    return cohorts.baseline_cohort(star.metadata(spark, sf_dir), STAR)


@query(f"{sql.BASELINE} SELECT project, count(*) AS n_samples FROM baseline GROUP BY project")
def samples_by_project(spark, sf_dir):
    return cohorts.breakdown(baseline_cohort(spark, sf_dir), "project")


def _by_subject(key: str) -> str:
    return f"""{sql.BASELINE}, once AS (SELECT * FROM baseline
  QUALIFY row_number() OVER (PARTITION BY subject ORDER BY sample) = 1)
SELECT {key}, count(*) AS n_subjects FROM once WHERE {key} IS NOT NULL GROUP BY {key}"""


@query(_by_subject("response"))
def subjects_by_response(spark, sf_dir):
    return cohorts.breakdown(baseline_cohort(spark, sf_dir), "response", one_per="subject")


@query(_by_subject("sex"))
def subjects_by_sex(spark, sf_dir):
    return cohorts.breakdown(baseline_cohort(spark, sf_dir), "sex", one_per="subject")


@query(f"""SELECT CAST(sum(n_subjects) AS BIGINT) AS total_subjects
FROM ({_by_subject('response')})""")
def subject_total(spark, sf_dir):
    return cohorts.subject_total(subjects_by_response(spark, sf_dir))


@query(f"""{sql.BASE} SELECT * EXCLUDE (o) FROM (
  SELECT {sql.META}, row_number() OVER (PARTITION BY subject ORDER BY {TIME}, sample) AS o
  FROM wide) WHERE o = 1""")
def first_sample_per_subject(spark, sf_dir):
    return cohorts.first_per(star.metadata(spark, sf_dir).select(*METADATA), "subject",
                             [TIME, "sample"]).select(*METADATA)


# --- statistics ---------------------------------------------------------------------------


def _stats(spark, sf_dir) -> DataFrame:
    return compare_scopes(star.cohort(spark, sf_dir), STAR)


STATS_LIST = ", ".join(STATS_COLUMNS)


@query(f"{sql.STATS} SELECT scope, timepoint, {STATS_LIST} FROM stats")
def scope_statistics(spark, sf_dir):
    return rounded(_stats(spark, sf_dir))


@query(f"{sql.STATS} SELECT {STATS_LIST} FROM stats WHERE scope = 'pooled'")
def pooled_statistics(spark, sf_dir):
    return rounded(one_scope(_stats(spark, sf_dir), "pooled", STAR))


@query(f"{sql.STATS} SELECT {STATS_LIST} FROM stats WHERE scope = 'baseline'")
def baseline_statistics(spark, sf_dir):
    return rounded(one_scope(_stats(spark, sf_dir), "baseline", STAR))


@query(f"{sql.STATS} SELECT timepoint, {STATS_LIST} FROM stats WHERE timepoint IS NOT NULL")
def timepoint_statistics(spark, sf_dir):
    return rounded(per_timepoint(_stats(spark, sf_dir), STAR))


@query(f"{sql.STATS} SELECT scope, timepoint, {STATS_LIST} FROM stats WHERE significant_primary")
def significant_components(spark, sf_dir):
    return rounded(flagged(_stats(spark, sf_dir)))


def _shifted(spark, sf_dir) -> DataFrame:
    return compare_scopes(star.shifted_cohort(spark, sf_dir), STAR)


@query(f"{sql.SHIFTED_STATS} SELECT scope, timepoint, {STATS_LIST} FROM stats")
def shifted_statistics(spark, sf_dir):
    """A study whose groups differ by construction: flags are TRUE at every scale."""
    return rounded(_shifted(spark, sf_dir))


@query(f"""{sql.SHIFTED_STATS} SELECT scope, timepoint, {STATS_LIST} FROM stats
WHERE significant_primary""")
def shifted_significant_components(spark, sf_dir):
    """The flagged rows of that study; tests assert that there are some."""
    return rounded(flagged(_shifted(spark, sf_dir)))


@query(f"""{sql.SHIFTED_STATS}, labelled AS (
  SELECT *, CASE response WHEN 'yes' THEN 'Responder' WHEN 'no' THEN 'Non-responder' END
    AS response_label FROM cohort), {sql.boxes('labelled', 'population, response_label')}
SELECT b.population, response_label, {sql.r('median')} AS median, n_outliers,
  CASE WHEN significant_primary THEN '**' ELSE 'ns' END AS marker
FROM boxes b JOIN stats s ON b.population = s.population AND s.scope = 'baseline'""")
def shifted_annotated_boxplots(spark, sf_dir):
    """Boxes and statistics read off one ranked histogram."""
    ranks = store.staged(scope_ranks(star.shifted_cohort(spark, sf_dir), STAR), "ranks")
    baseline = one_scope(statistics_of_ranks(ranks, STAR), "baseline", STAR)
    shown = annotate(boxes_of_ranks(ranks, STAR)[0], baseline, STAR)
    return rounded(shown.select("population", "response_label", "median", "n_outliers", "marker"))


@query("""SELECT o_orderpriority, o_orderstatus, o_orderkey % 7 AS seventh,
  printf('%.3f', count(*) / 16::DOUBLE) AS three, printf('%.4f', count(*) / 32::DOUBLE) AS four
FROM orders GROUP BY ALL""")
def tied_formats_of_counts(spark, sf_dir):
    """Sixteenths and thirty-seconds of the counts of all orders, as a shown table has them: odd counts
    tie, and ties go to the even digit."""
    counts = star.table(spark, sf_dir, "orders").groupBy(
        "o_orderpriority", "o_orderstatus", (F.col("o_orderkey") % 7).alias("seventh")).agg(
            F.count(F.lit(1)).alias("n"))
    return counts.select("o_orderpriority", "o_orderstatus", "seventh",
                         fixed_decimals(F.col("n") / 16, 3).alias("three"),
                         fixed_decimals(F.col("n") / 32, 4).alias("four"))


@query("""SELECT o_orderkey, printf('%.3f', o_orderkey / 16::DOUBLE) AS three,
  printf('%.4f', o_orderkey / 32::DOUBLE) AS four FROM orders""")
def tied_formats_of_all(spark, sf_dir):
    """The same numbers of every order."""
    return star.table(spark, sf_dir, "orders").select(
        "o_orderkey", fixed_decimals(F.col("o_orderkey") / 16, 3).alias("three"),
        fixed_decimals(F.col("o_orderkey") / 32, 4).alias("four"))


def _balances(spark, sf_dir) -> DataFrame:
    """The tails cost up to a tenth of a millisecond a row, and all customers may be one small file."""
    columns = star.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return spread(columns, rows_per_task=10_000)


@query(f"""SELECT c_custkey, {sql.r("""CASE c_custkey % 3 WHEN 0 THEN 1 - 2 / pi() * atan(t)
  WHEN 1 THEN 1 - t / sqrt(t * t + 2)
  ELSE 1 - 0.75 * t / sqrt(1 + t * t / 4) * (1 - t * t / (12 * (1 + t * t / 4))) END""", 8)}
  AS two_sided FROM (SELECT c_custkey, abs(c_acctbal / 2500) AS t FROM customer)""")
def student_t_closed_forms(spark, sf_dir):
    """Against the closed forms of 1, 2 and 4 degrees of freedom."""
    p = student_t_two_sided("c_acctbal / 2500",
                            "CASE c_custkey % 3 WHEN 0 THEN 1D WHEN 1 THEN 2D ELSE 4D END")
    return rounded(_balances(spark, sf_dir).select("c_custkey", p.alias("two_sided")), 8)


@query(f"""{sql.STATS} SELECT scope, timepoint, {STATS_LIST} FROM stats
WHERE scope <> 'baseline'""")
def statistics_by_table_write(spark, sf_dir):
    """Written as one table partitioned by scope, read back with the scope as a filter."""
    path = store.working_dir(spark)
    stats = _stats(spark, sf_dir)
    store.write_table(stats.coalesce(1), path, "csv", partition_by="scope")
    back = store.read_optional(spark, path, "csv", stats.schema)
    return rounded(back.where(F.col("scope") != "baseline").select(*stats.columns))


@query(f"""{sql.STATS} SELECT population, printf('%.4f', mwu_p_bh) AS mwu_p_bh,
  printf('%.4f', t_p_bh) AS t_p_bh, printf('%.4f', mwu_p_raw) AS mwu_p_raw,
  printf('%.4f', t_p_raw) AS t_p_raw, printf('%.3f', rank_biserial) AS rank_biserial,
  printf('%.3f', mean_difference) AS mean_difference,
  printf('%.3f', median_difference) AS median_difference
FROM stats WHERE scope = 'baseline'""")
def formatted_statistics(spark, sf_dir):
    shown = formatted_stats(rounded(one_scope(_stats(spark, sf_dir), "baseline", STAR)))
    return shown.select("population", "mwu_p_bh", "t_p_bh", "mwu_p_raw", "t_p_raw",
                        "rank_biserial", "mean_difference", "median_difference")


def _prices(spark, sf_dir, **options) -> DataFrame:
    line = star.table(spark, sf_dir, "lineitem")
    return two_group_compare(line, ["l_linestatus"], "l_returnflag", "l_extendedprice", "A", "R",
                             **options)


PRICES = "WITH " + sql.comparison("lineitem", "l_linestatus", "l_returnflag", "l_extendedprice",
                                  "A", "R")


@query(f"""{PRICES} SELECT l_linestatus, n_a, n_b, {sql.r('t_stat')} AS t_stat,
  {sql.r('t_df', 4)} AS t_df, {sql.r('t_p_raw')} AS t_p_raw FROM compared""")
def welch_t_test(spark, sf_dir):
    found = _prices(spark, sf_dir).withColumn("t_df", F.round("t_df", 4) + F.lit(0.0))
    return rounded(found.select("l_linestatus", "n_a", "n_b", "t_stat", "t_df", "t_p_raw"))


@query(f"""{PRICES} SELECT l_linestatus, n_a, n_b, CAST(u_doubled AS BIGINT) AS u_doubled,
  CAST(tie_sum AS BIGINT) AS tie_sum, {sql.r('mwu_p_raw')} AS mwu_p_raw,
  {sql.r('rank_biserial')} AS rank_biserial FROM compared""")
def mann_whitney_test(spark, sf_dir):
    """Counted in value ranges, as large groups are."""
    found = _prices(spark, sf_dir)
    return rounded(found.select(
        "l_linestatus", "n_a", "n_b", F.col("u_doubled").cast("bigint").alias("u_doubled"),
        F.col("tie_sum").cast("bigint").alias("tie_sum"), "mwu_p_raw", "rank_biserial"))


@query(f"""{PRICES} SELECT l_linestatus, n_a, n_b, {sql.r('mean_a')} AS mean_a,
  {sql.r('mean_b')} AS mean_b, {sql.r('median_a')} AS median_a, {sql.r('median_b')} AS median_b,
  {sql.r('mean_difference')} AS mean_difference,
  {sql.r('median_difference')} AS median_difference FROM compared""")
def group_locations(spark, sf_dir):
    found = _prices(spark, sf_dir)
    return rounded(found.select("l_linestatus", "n_a", "n_b", "mean_a", "mean_b", "median_a",
                                "median_b", "mean_difference", "median_difference"))


@query("""WITH hist AS (SELECT l_returnflag, l_extendedprice AS price, count(*) AS n_all
  FROM lineitem GROUP BY ALL)
SELECT l_returnflag, price, n_all, CAST(sum(n_all) OVER (PARTITION BY l_returnflag ORDER BY price)
  - n_all AS BIGINT) AS before_all,
  CAST(sum(n_all) OVER (PARTITION BY l_returnflag) AS BIGINT) AS total_all FROM hist""")
def value_ranks(spark, sf_dir):
    line = star.table(spark, sf_dir, "lineitem").withColumnRenamed("l_extendedprice", "price")
    found = ranked_histogram(line, ["l_returnflag"], "price", {"all": "true"},
                             rows_per_range=50)
    return found.select("l_returnflag", "price", "n_all", "before_all", "total_all")


LINE_P = f"""WITH z AS (SELECT l_linestatus, l_returnflag, l_linenumber,
  (avg(l_quantity) - 25.5::DOUBLE) / (14.43::DOUBLE / sqrt(count(*))) AS z
  FROM lineitem GROUP BY ALL),
raw AS (SELECT *, {sql.normal_sf('z')} AS p FROM z),
{sql.adjusted('p', 'p_bh', 'raw', 'done', 'l_linestatus')}"""


@query(f"SELECT l_linestatus, l_returnflag, l_linenumber, {sql.r('p')} AS p, "
       f"{sql.r('p_bh')} AS p_bh FROM ({LINE_P} SELECT * FROM done)")
def adjusted_p_values(spark, sf_dir):
    """Mean quantity of each flag and line number against the overall one, adjusted within each
    line status. A family has as many members as there are flags and line numbers."""
    members = ["l_linestatus", "l_returnflag", "l_linenumber"]
    means = star.table(spark, sf_dir, "lineitem").groupBy(*members).agg(
        F.avg("l_quantity").alias("m"), F.count(F.lit(1)).alias("n"))
    raw = means.select(*members, normal_sf("(m - 25.5D) / (14.43D / sqrt(n))").alias("p"))
    return rounded(bh_adjust(raw, ["l_linestatus"], {"p": "p_bh"}))


CUSTOMER_P = f"""WITH raw AS (SELECT c_custkey, c_mktsegment,
  round({sql.normal_sf('((c_acctbal - 4500) / 1500)')}, 4) AS p FROM customer),
{sql.adjusted('p', 'p_bh', 'raw', 'done', 'c_mktsegment')}"""


@query(f"{CUSTOMER_P} SELECT c_custkey, c_mktsegment, p, {sql.r('p_bh')} AS p_bh FROM done")
def adjusted_p_values_of_customers(spark, sf_dir):
    """Every customer's balance as a p-value with ties, adjusted within market segments: families that
    grow with the table and are cut into ranges."""
    p = F.expr("round(upper_tail, 4)").alias("p")
    raw = star.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", normal_sf("(c_acctbal - 4500) / 1500").alias("upper_tail"))
    return rounded(bh_adjust_families(raw.select("c_custkey", "c_mktsegment", p), ["c_mktsegment"],
                                      {"p": "p_bh"}, rows_per_range=100))


@query(f"""SELECT c_custkey, {sql.r(sql.normal_sf('((c_acctbal - 4500) / 1500)'), 8)} AS upper_tail
FROM customer""")
def normal_tail(spark, sf_dir):
    tail = normal_sf("(c_acctbal - 4500) / 1500").alias("upper_tail")
    return rounded(_balances(spark, sf_dir).select("c_custkey", tail), 8)


@query(f"""SELECT c_custkey, {sql.r(sql.student_t('(c_acctbal / 2500)',
  '(c_custkey % 97 + 1.25::DOUBLE)'), 8)} AS two_sided FROM customer""")
def student_t_tail(spark, sf_dir):
    p = student_t_two_sided("c_acctbal / 2500", "c_custkey % 97 + 1.25D").alias("two_sided")
    return rounded(_balances(spark, sf_dir).select("c_custkey", p), 8)


def _summary_lines(spark, stats: DataFrame, chosen: DataFrame, study) -> DataFrame:
    text = significance_summary(stats, cohorts.cohort_profile(chosen, study), study)
    return spark.createDataFrame(list(enumerate(text.split("\n"), 1)), "line_no int, line string")


@query(sql.summary(sql.STATS, STAR))
def summary_text(spark, sf_dir):
    chosen = cohorts.comparison_cohort(star.metadata(spark, sf_dir), STAR)
    return _summary_lines(spark, _stats(spark, sf_dir), chosen, STAR)


@query(sql.summary(sql.SHIFTED_STATS, star.SHIFTED))
def shifted_summary_text(spark, sf_dir):
    """The text of a study with findings, whose cohort fixes no sample type."""
    return _summary_lines(spark, _shifted(spark, sf_dir), star.shifted_samples(spark, sf_dir),
                          star.SHIFTED)


# --- box plots ----------------------------------------------------------------------------


_BOX = ", ".join(f"{sql.r(c)} AS {c}" for c in
                 ("whisker_low", "q1", "median", "q3", "whisker_high"))


def _boxes(spark, sf_dir, by_time: bool = False, **options):
    return study_boxes(star.cohort(spark, sf_dir), STAR, by_time=by_time, **options)


@query(f"""{sql.LABELLED} SELECT population, {sql.r('percentage')} AS percentage, response, {TIME},
  response_label FROM labelled""")
def boxplot_rows(spark, sf_dir):
    return rounded(boxplot_input(star.cohort(spark, sf_dir), STAR))


@query(f"""{sql.LABELLED}, {sql.boxes('labelled', 'population, response_label')}
SELECT population, response_label, n, {_BOX}, n_outliers FROM boxes""")
def boxplots(spark, sf_dir):
    return rounded(_boxes(spark, sf_dir)[0])


@query(f"""{sql.LABELLED}, picked AS (SELECT * FROM labelled WHERE {TIME} IN (0, 7, 14)),
{sql.boxes('picked', f'population, {TIME}, response_label')}
SELECT population, {TIME}, response_label, n, {_BOX}, n_outliers FROM boxes""")
def boxplots_by_time(spark, sf_dir):
    return rounded(_boxes(spark, sf_dir, by_time=True)[0])


@query(f"""{sql.LABELLED}, {sql.boxes('labelled', 'population, response_label')}
SELECT s.population, s.response_label, {sql.r('percentage')} AS percentage, count(*) AS n
FROM labelled s JOIN fences f ON s.population = f.population
  AND s.response_label = f.response_label
WHERE percentage < low OR percentage > high
GROUP BY s.population, s.response_label, s.percentage""")
def boxplot_outliers(spark, sf_dir):
    return rounded(_boxes(spark, sf_dir)[1])


_TITLES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STAR.labels.items())


@query(f"""{sql.STATS}, labelled AS (
  SELECT *, CASE response WHEN 'yes' THEN 'Responder' WHEN 'no' THEN 'Non-responder' END
    AS response_label FROM cohort), {sql.boxes('labelled', 'population, response_label')}
SELECT b.population, response_label, {sql.r('median')} AS median, mwu_p_bh, t_p_bh,
  CASE WHEN significant_primary THEN '**' ELSE 'ns' END AS marker,
  CASE b.population {_TITLES} ELSE b.population END AS title
FROM boxes b JOIN stats s ON b.population = s.population AND s.scope = 'baseline'""")
def annotated_boxplots(spark, sf_dir):
    baseline = one_scope(_stats(spark, sf_dir), "baseline", STAR)
    shown = annotate(_boxes(spark, sf_dir)[0], baseline, STAR)
    return rounded(shown.select("population", "response_label", "median", "mwu_p_bh", "t_p_bh",
                                "marker", "title"))


# --- overview and exploration -------------------------------------------------------------


@query(f"""WITH {sql.SUBJECTS}, {sql.SAMPLES}, {sql.METADATA_CTE}
SELECT 'n_samples' AS metric, NULL AS value, count(*) AS n FROM taken UNION ALL
SELECT 'n_subjects', NULL, count(*) FROM people UNION ALL
SELECT 'n_projects', NULL, count(*) FROM nation UNION ALL
SELECT 'n_populations', NULL, {len(STAR.components)} UNION ALL
SELECT 'condition', condition, count(*) FROM people GROUP BY condition UNION ALL
SELECT 'treatment', treatment, count(*) FROM people GROUP BY treatment UNION ALL
SELECT 'sample_type', sample_type, count(*) FROM taken GROUP BY sample_type""")
def overview(spark, sf_dir):
    return views.overview(star.tables(spark, sf_dir), STAR)


@query(f"WITH {sql.SUBJECTS} SELECT DISTINCT response FROM people")
def response_vocabulary(spark, sf_dir):
    return views.vocabulary(star.tables(spark, sf_dir)["subjects"], "response")


@query(f"""WITH {sql.SUBJECTS}, {sql.SAMPLES}, {sql.METADATA_CTE}, pairs AS (
  SELECT 'condition' AS metric, condition AS value FROM meta UNION ALL
  SELECT 'sample_type', sample_type FROM meta UNION ALL SELECT 'sex', sex FROM meta UNION ALL
  SELECT 'response', response FROM meta)
SELECT metric, value, count(*) AS n FROM pairs GROUP BY metric, value""")
def vocabulary_counts(spark, sf_dir):
    return views.vocabulary_counts(norm.sample_metadata(star.tables(spark, sf_dir)),
                                   ["condition", "sample_type", "sex", "response"])


@query(f"""{sql.FREQUENCIES} SELECT min(total_count) AS min_total, max(total_count) AS max_total,
  count(*) AS n_rows FROM long""")
def total_range(spark, sf_dir):
    return views.total_range(table_frequencies(star.tables(spark, sf_dir), STAR))


CHOSEN = ["A_F", "N_O"]
CHOSEN_SQL = f"population IN ({sql.in_list(CHOSEN)}) AND contains(lower(sample), '42')"


@query(f"""{sql.FREQUENCIES} SELECT sample, total_count, population, count,
  round_even(percentage * 100, 0) / 100 AS percentage FROM long WHERE {CHOSEN_SQL}""")
def explore_frequencies(spark, sf_dir):
    return views.explore(table_frequencies(star.tables(spark, sf_dir), STAR), CHOSEN, "42")


@query(f"""{sql.FREQUENCIES} SELECT count(*) AS n_rows FROM long
WHERE population IN ({sql.in_list(CHOSEN)}) AND regexp_matches(sample, '^1.*7$')""")
def explore_row_count(spark, sf_dir):
    frequencies = table_frequencies(star.tables(spark, sf_dir), STAR)
    shown = views.explore(frequencies, CHOSEN, "^1.*7$", regex=True)
    return shown.agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"{sql.FREQUENCIES} SELECT {FREQUENCY_SQL} FROM long WHERE {CHOSEN_SQL}")
def explore_export(spark, sf_dir):
    path = store.working_dir(spark)
    frequencies = table_frequencies(star.tables(spark, sf_dir), STAR)
    store.write_table(views.explore(frequencies, CHOSEN, "42", rounded=False), path, "csv")
    return rounded(store.read_optional(spark, path, "csv", frequencies.schema))


# --- order as data ------------------------------------------------------------------------


def _positions(spark, df: DataFrame, key: str) -> DataFrame:
    """(key, position) of the rows of ``df`` as its written files hold them, in file order.

    Files are numbered by their names and rows within a file's part by their ids; only the list
    of parts is ordered in one task.
    """
    path = store.working_dir(spark)
    store.write_table(df, path, "csv")
    read = store.read_optional(spark, path, "csv", df.schema).selectExpr(
        f"{key} AS key", "_metadata.file_name AS file", "_metadata.file_block_start AS start",
        "monotonically_increasing_id() AS id")
    parts = read.groupBy("file", "start").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = parts.selectExpr("file", "start", "first", "sum(n) OVER (ORDER BY file, start) - n "
                              "AS before")
    return read.join(F.broadcast(before), ["file", "start"]).selectExpr(
        "key", "before + id - first + 1 AS position")


@query(f"""{sql.FREQUENCIES} SELECT concat_ws('|', sample, population) AS key, row_number() OVER (
  ORDER BY sample, {sql.rank('population')}) AS position FROM long""")
def frequency_order(spark, sf_dir):
    made = ordered_frequencies(star.tables(spark, sf_dir), STAR)
    return _positions(spark, made, "concat_ws('|', sample, population)")


@query(f"""{sql.BASELINE} SELECT sample AS key, row_number() OVER (ORDER BY sample) AS position
FROM baseline""")
def baseline_order(spark, sf_dir):
    chosen = cohorts.baseline_cohort(star.metadata(spark, sf_dir), STAR)
    return _positions(spark, chosen.orderBy("sample"), "sample")


@query(f"""{sql.BASELINE} SELECT project AS key, row_number() OVER (ORDER BY project) AS position
FROM (SELECT DISTINCT project FROM baseline)""")
def breakdown_order(spark, sf_dir):
    chosen = cohorts.baseline_cohort(star.metadata(spark, sf_dir), STAR)
    return _positions(spark, cohorts.breakdown(chosen, "project"), "project")


@query(f"""WITH {sql.SUBJECTS} SELECT condition AS key, row_number() OVER (ORDER BY condition)
  AS position FROM (SELECT DISTINCT condition FROM people)""")
def vocabulary_order(spark, sf_dir):
    return _positions(spark, views.vocabulary(star.tables(spark, sf_dir)["subjects"], "condition"),
                      "condition")


@query(f"""{sql.STATS} SELECT concat_ws('|', scope, population) AS key, row_number() OVER (
  ORDER BY CASE scope WHEN 'pooled' THEN -2 WHEN 'baseline' THEN -1 ELSE timepoint END,
  {sql.rank('population')}) AS position FROM stats""")
def statistics_order(spark, sf_dir):
    made = _stats(spark, sf_dir).orderBy(*stats_order(STAR))
    return _positions(spark, made, "concat_ws('|', scope, population)")


@query("SELECT sex, count(*) AS n_subjects FROM (SELECT 'F' AS sex FROM region WHERE false) "
       "GROUP BY sex")
def empty_breakdown(spark, sf_dir):
    """A cohort that no sample is in: no rows, the two columns stay."""
    nobody = cohorts.select_cohort(star.metadata(spark, sf_dir), {"condition": "nothing"})
    return cohorts.breakdown(nobody, "sex", one_per="subject")


# --- everything ---------------------------------------------------------------------------


_STATS_CELLS = " ".join(
    c if c in ("population", "n_responder", "n_nonresponder", "significant_primary",
               "significant_high_confidence") else f"{c}:double" for c in STATS_COLUMNS)
_BOX_CELLS = ("population response_label n n_outliers whisker_low:double q1:double median:double "
              "q3:double whisker_high:double")
_WHOLE_LABELLED = """labelled AS (
  SELECT *, CASE response WHEN 'yes' THEN 'Responder' WHEN 'no' THEN 'Non-responder' END
    AS response_label FROM cohort)"""
_OUTSIDE = ("(SELECT {keys}, percentage, count(*) AS n FROM labelled s JOIN fences f USING ({keys}) "
            "WHERE percentage < low OR percentage > high GROUP BY {keys}, percentage)")
_COHORT_SQL = " AND ".join(f"{k} = '{v}'" for k, v in STAR.cohort.items())


def _box_ctes(keys: str, prefix: str) -> str:
    made = sql.boxes("labelled" if prefix == "pooled" else "timed_rows", keys)
    for name in ("quartiles", "fences", "boxes"):
        made = made.replace(f"{name} AS (", f"{prefix}_{name} AS (").replace(
            f"FROM {name}", f"FROM {prefix}_{name}").replace(f"JOIN {name}", f"JOIN {prefix}_{name}")
    return made


_TIMED_KEYS = f"population, {TIME}, response_label"
WHOLE = sql.on_filled(sql.STATS) + f""", {_WHOLE_LABELLED},
timed_rows AS (SELECT * FROM labelled WHERE {TIME} IN (0, 7, 14)),
{_box_ctes('population, response_label', 'pooled')},
{_box_ctes(_TIMED_KEYS, 'timed')},
started AS (SELECT DISTINCT {', '.join(COHORT_COLUMNS)} FROM long
  WHERE {_COHORT_SQL} AND {TIME} = 0),
firsts AS (SELECT subject, arg_min(COALESCE(response, ''), sample) AS response,
  arg_min(sex, sample) AS sex FROM started GROUP BY subject)
""" + _contents_sql(
    cell_frequencies=("sample total_count population count percentage:double", "long"),
    stats=(f"scope timepoint {_STATS_CELLS}", "stats"),
    boxplots=(f"{_BOX_CELLS} title marker mwu_p_bh:double t_p_bh:double", f"""(
      SELECT b.*, mwu_p_bh, t_p_bh, CASE WHEN significant_primary THEN '**' ELSE 'ns' END AS marker,
        CASE b.population {_TITLES} ELSE b.population END AS title
      FROM pooled_boxes b JOIN stats s ON b.population = s.population AND s.scope = 'baseline')"""),
    boxplot_outliers=("population response_label percentage:double n", _OUTSIDE.format(
        keys="population, response_label").replace("fences", "pooled_fences")),
    boxplots_per_timepoint=(f"{_BOX_CELLS} {TIME}", "timed_boxes"),
    boxplot_outliers_per_timepoint=(
        f"population {TIME} response_label percentage:double n", _OUTSIDE.format(
            keys=_TIMED_KEYS).replace("fences", "timed_fences").replace("labelled", "timed_rows")),
    part4_baseline_samples=(" ".join(COHORT_COLUMNS), "started"),
    part4_by_project=("project n_samples",
                      "(SELECT project, count(*) AS n_samples FROM started GROUP BY project)"),
    part4_by_response=("response n_subjects", "(SELECT response, count(*) AS n_subjects FROM firsts "
                       "WHERE response <> '' GROUP BY response)"),
    part4_by_sex=("sex n_subjects",
                  "(SELECT sex, count(*) AS n_subjects FROM firsts GROUP BY sex)"),
    stats_summary=("line", f"({sql.summary_lines(STAR)})"))


@query(WHOLE)
def whole_study(spark, sf_dir):
    """Load, then every job: all rows of all result tables, as written."""
    return _contents(analyse(_loaded(spark, sf_dir), store.shared_dir(spark), STAR))
