"""Validation rules. Each returns the offending rows as a DataFrame; nothing stops at the first.

Every rule combines partial results before its shuffle, so a sample or subject with very many
rows does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.operators.skew import spread
from tallyfold.sources.wide_csv import MALFORMED, UNCASTABLE, InvalidInput
from tallyfold.study import FOREIGN_KEYS, PRIMARY_KEYS, SUBJECT_INVARIANTS, TABLES, Study

# Rules of the wide input in reporting order.
RULES = ("malformed_row", "duplicate_sample", "negative_count", "zero_total", "subject_drift",
         "not_integer", "missing_key")
# The message of each rule.
MESSAGES = {
    "malformed_row": "load_data: a record with more or fewer fields than the header: {detail}",
    "duplicate_sample": "load_data: duplicate sample id: {key!r}",
    "negative_count": "load_data: negative count for population {column!r} in sample {key!r}: "
                      "{detail}",
    "zero_total": "load_data: zero total cell count for sample {key!r}",
    "subject_drift": "load_data: subject {key!r} has inconsistent values for column {column!r}",
    "not_integer": "load_data: no whole number in column {column!r} of sample {key!r}",
    "missing_key": "load_data: missing {column!r} in sample {key!r}",
}
VIOLATION_COLUMNS = ("rule", "key", "column", "detail")


def _finding(rule: str, key: str = "`sample`", column: str = "NULL", detail: str = "NULL",
             major: str = "0", minor: str = "0") -> str:
    """SQL of one finding; (rule_no, major, key, minor) is the reporting order."""
    parts = {"rule_no": RULES.index(rule), "major": f"CAST({major} AS INT)", "rule": f"'{rule}'",
             "key": f"CAST({key} AS STRING)", "column": f"CAST({column} AS STRING)",
             "detail": f"CAST({detail} AS STRING)", "minor": f"CAST({minor} AS INT)"}
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in parts.items()) + ")"


def _short_finding(rule: str, column: str = "NULL", detail: str = "NULL", major: str = "0") -> str:
    """SQL of what tells a row's finding from its others; ``_whole_findings`` adds the rest."""
    parts = {"rule_no": f"CAST({RULES.index(rule)} AS INT)", "major": f"CAST({major} AS INT)",
             "column": f"CAST({column} AS STRING)", "detail": f"CAST({detail} AS STRING)"}
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in parts.items()) + ")"


def _whole_findings(found: str) -> str:
    """SQL of a row's findings, in the shape of ``_finding``, from its key and short ones."""
    rules = ", ".join(f"'{rule}'" for rule in RULES)
    parts = {"rule_no": "f.rule_no", "major": "f.major", "rule": f"array({rules})[f.rule_no]",
             "key": f"{found}.key", "column": "f.column", "detail": "f.detail", "minor": "0"}
    whole = "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in parts.items()) + ")"
    return f"transform({found}.short, f -> {whole})"


def _row_findings(df: DataFrame, study: Study) -> tuple[str, str]:
    """SQL of a row's key and short findings, and of the condition that it can have any."""
    total = " + ".join(f"coalesce(`{c}`, 0L)" for c in study.components)
    broken = {}
    if MALFORMED in df.columns:
        broken[f"{MALFORMED} IS NOT NULL"] = _short_finding("malformed_row", detail=MALFORMED)
    broken |= {f"`{c}` < 0": _short_finding("negative_count", column=repr(c), detail=f"`{c}`",
                                             major=i)
              for i, c in enumerate(study.components)}
    broken[f"{total} = 0"] = _short_finding("zero_total")
    broken.update({f"`{c}` IS NULL": _short_finding("missing_key", column=repr(c), major=i)
                   for i, c in enumerate(("project", "subject", "sample"))})
    found = ", ".join(f"IF({condition}, {finding}, NULL)" for condition, finding in broken.items())
    found, suspect = f"array_compact(array({found}))", " OR ".join(broken)
    if UNCASTABLE in df.columns:
        uncast = _short_finding("not_integer", column="name", major="i")
        found = f"concat({found}, transform({UNCASTABLE}, (name, i) -> {uncast}))"
        suspect += f" OR size({UNCASTABLE}) > 0"
    return f"named_struct('key', CAST(`sample` AS STRING), 'short', {found})", suspect


def violations(df: DataFrame, study: Study) -> DataFrame:
    """Every broken rule of the wide input; order by ``report_order()`` to read them.

    Hardly any two rows share a group, so a task holds its rows: of a stored table, ``spread`` them.

    The input is scanned once. Each row is expanded by grain: for its sample, for its subject and for
    its own findings (none for most rows, which so are one group), and one aggregate serves all
    three. Samples are counted; of a subject's attributes the least and the largest 64-bit hash are
    kept, whose difference is a drift; findings are counted and given back as often as they occur. They
    go through the aggregate without what follows from the rule and the row.
    """
    found, suspect = _row_findings(df, study)
    # NULL is no value, but for the response, whose NULL has a hash like any text.
    hashes = [f"xxhash64(`{c}`)" if c == "response" else f"IF(`{c}` IS NULL, NULL, xxhash64(`{c}`))"
              for c in SUBJECT_INVARIANTS]
    rows = df.selectExpr("`sample` AS _sample", "subject AS _subject",
                         f"IF({suspect}, {found}, NULL) AS _found",
                         *[f"{h} AS _hash_{i}" for i, h in enumerate(hashes)])
    merged = rows.groupingSets(
        [["_sample"], ["_subject"], ["_found"]], "_sample", "_subject", "_found").agg(
        F.grouping_id().alias("_grain"), F.count(F.lit(1)).alias("n"), *[
            F.expr(f"{side}(_hash_{i})").alias(f"_{side}_{i}")
            for i in range(len(hashes)) for side in ("min", "max")])
    repeated = _finding("duplicate_sample", key="_sample", column="'sample'", detail="n")
    drifted = ", ".join(
        f"IF(_min_{i} < _max_{i}, "
        f"{_finding('subject_drift', key='_subject', column=repr(c), minor=i)}, NULL)"
        for i, c in enumerate(SUBJECT_INVARIANTS))
    drifts = " OR ".join(f"_min_{i} < _max_{i}" for i in range(len(hashes)))
    of_sample, of_subject, of_row = (f"_grain = {0b111 - (0b100 >> i)}" for i in range(3))
    return merged.where(f"({of_sample} AND n > 1) OR ({of_row} AND _found IS NOT NULL) OR "
                        f"({of_subject} AND _subject IS NOT NULL AND ({drifts}))").selectExpr(
        f"""inline(CASE WHEN {of_sample} THEN array({repeated})
          WHEN {of_subject} THEN array_compact(array({drifted}))
          ELSE flatten(array_repeat({_whole_findings('_found')}, CAST(n AS INT))) END)""")


def drift(df: DataFrame, owner: str, columns: Iterable[str],
          blank_as_value: Iterable[str] = ()) -> DataFrame:
    """(owner, column) pairs with more than one value.

    NULL is no value, except in the ``blank_as_value`` columns. min < max per column finds every
    drift in one aggregate, combined before the shuffle.
    """
    blanks, columns = set(blank_as_value), list(columns)
    # A flag in front keeps a blank apart from every text.
    seen = {c: f"struct(`{c}` IS NULL, `{c}`)" if c in blanks else f"`{c}`" for c in columns}
    # Distinct rows first, by hash; min and max of texts sort, and so see few rows.
    distinct = df.select(owner, *columns).distinct()
    bounds = distinct.groupBy(owner).agg(*[
        F.expr(f"{side}({seen[c]})").alias(f"_{side}_{c}")
        for c in columns for side in ("min", "max")])
    drifted = ", ".join(
        f"IF(`_min_{c}` < `_max_{c}`, named_struct('column', '{c}', 'position', {i}), NULL)"
        for i, c in enumerate(columns))
    found = bounds.selectExpr(f"`{owner}`", f"explode_outer(array_compact(array({drifted}))) AS d")
    return found.where("d IS NOT NULL").select(owner, "d.column", "d.position")


def report_order() -> list[Column]:
    return [F.col("rule_no"), F.col("major"), F.col("key"), F.col("minor")]


def first_violation(found: DataFrame) -> dict | None:
    """The first finding by rule, then key: a top-1, whatever the number of findings."""
    rows = found.orderBy(*report_order()).limit(1).collect()
    return rows[0].asDict() if rows else None


def require_valid(df: DataFrame, study: Study) -> None:
    """Refuse a stored wide table that breaks a rule."""
    worst = first_violation(violations(spread(df), study))
    if worst is not None:
        raise InvalidInput(MESSAGES[worst["rule"]].format(**worst))


# --- rules of the normalised tables ---------------------------------------------------------


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values used by more than one row, with ``n`` rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent row, with ``n`` child rows. NULL is no reference.

    Child keys are counted first, so the join sees each key once.
    """
    used = (child.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n")))
    known = parent.select(F.col(parent_key).alias(key))
    return used.join(known, key, "left_anti")


def missing_values(df: DataFrame, required: list[str]) -> DataFrame:
    """(column, n) of required columns with NULLs, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return (counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in required])).alias("m"))
        .select("m.*").where(F.col("n") > 0))


def negative_counts(counts: DataFrame, value: str = "count") -> DataFrame:
    return counts.where(F.col(value) < 0)


def incomplete_entities(counts: DataFrame, entity: str, expected: int) -> DataFrame:
    """Entities whose number of rows is not the expected one, with ``n`` rows."""
    return (counts.groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") != expected))


def open_compositions(frequencies: DataFrame, entity: str = "sample",
                      tolerance: float = 1e-6) -> DataFrame:
    """Entities whose percentages do not add up to 100."""
    return (frequencies.groupBy(entity).agg(F.sum("percentage").alias("percentage_sum"))
            .where(F.abs(F.col("percentage_sum") - 100.0) >= tolerance))


def unexpected_values(df: DataFrame, column: str, expected: Iterable) -> DataFrame:
    """Distinct non-null values outside the vocabulary."""
    return df.where(~F.col(column).isin(list(expected))).select(column).distinct()


def absent_values(df: DataFrame, column: str, expected: Iterable) -> DataFrame:
    """Vocabulary entries no row has."""
    entries = df.sparkSession.createDataFrame([(e,) for e in expected],
                                              df.select(column).schema)
    return entries.join(df.select(column).distinct(), column, "left_anti")


def join_cardinality(facts: DataFrame, joined: DataFrame) -> DataFrame:
    """One row: fact rows, joined rows and whether the join kept each fact exactly once."""
    n_facts = facts.agg(F.count(F.lit(1)).alias("n_facts"), F.lit(1).alias("_one"))
    n_joined = joined.agg(F.count(F.lit(1)).alias("n_joined"), F.lit(1).alias("_one"))
    return (n_facts.join(n_joined, "_one").drop("_one")
            .withColumn("complete", F.col("n_facts") == F.col("n_joined")))


def table_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rule, key, n): missing values, repeated primary keys, orphans, negative counts.

    The tables are stored ones; keys are spread over tasks before they are counted.
    """
    parts = []

    def add(table: str, rule: str, found: DataFrame, key: Column, n: Column) -> None:
        parts.append(found.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"),
                                  key.cast("string").alias("key"), n.cast("bigint").alias("n")))

    for name, schema in TABLES.items():
        required = [f.name for f in schema if not f.nullable]
        add(name, "missing_value", missing_values(tables[name], required), F.col("column"),
            F.col("n"))
        key = list(PRIMARY_KEYS[name])
        add(name, "duplicate_key", duplicate_keys(spread(tables[name].select(*key)), key), F.concat_ws("|", *key),
            F.col("n"))
    for child, key, parent in FOREIGN_KEYS:
        found = orphans(spread(tables[child].select(key)), key, tables[parent], PRIMARY_KEYS[parent][0])
        add(child, "orphan", found, F.col(key), F.col("n"))
    add("cell_counts", "negative_count", negative_counts(tables["cell_counts"]),
        F.concat_ws("|", "sample_id", "population"), F.lit(1))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
