import pytest

from tallyfold import CLINICAL
from tallyfold.operators import checks, normalize as norm, skew
from tallyfold.operators.normalize import normalize
from tallyfold.sources.tables import empty_tables
from tallyfold.plans.jobs import ordered_frequencies
from tallyfold.sources.wide_csv import InvalidInput, column_differences, require_columns
from verification import star
from verification.queries import QUERIES

COUNTS = {c: 0 for c in CLINICAL.components}


def found(df):
    return {(r.rule, r.key, r.column) for r in checks.violations(df, CLINICAL).collect()}


def test_valid_row(wide_frame):
    assert found(wide_frame({})) == set()
    checks.require_valid(wide_frame({}), CLINICAL)


def test_column_contract():
    columns = [c for c in CLINICAL.wide_columns if c != "age"] + ["extra_col"]
    assert column_differences(columns, CLINICAL) == (["age"], ["extra_col"])
    with pytest.raises(InvalidInput, match=r"load_data: missing columns: \['age'\]; "
                                           r"unexpected columns: \['extra_col'\]"):
        require_columns(columns, CLINICAL)
    require_columns(list(reversed(CLINICAL.wide_columns)), CLINICAL)


@pytest.mark.parametrize("rows,message", [
    ([{}, {"subject": "sub2"}], "duplicate sample id: 'v-204'"),
    ([{"b_cell": -1}], "negative count for population 'b_cell' in sample 'v-204': -1"),
    ([COUNTS], "zero total cell count for sample 'v-204'"),
    ([{}, {"sample": "smp2", "condition": "carcinoma"}],
     "subject 'p-17' has inconsistent values for column 'condition'"),
    ([{"age": "abc"}], "no whole number in column 'age'"),
    ([{"age": None}], "no whole number in column 'age'"),
    ([{"nk_cell": "1.5"}], "no whole number in column 'nk_cell'"),
    ([{"project": None}], "missing 'project' in sample 'v-204'"),
])
def test_each_rule(wide_frame, rows, message):
    with pytest.raises(InvalidInput, match="load_data: ") as error:
        checks.require_valid(wide_frame(*rows), CLINICAL)
    assert message in str(error.value)


def test_whole_numbers_written_as_decimals_are_accepted(wide_frame):
    df = wide_frame({"nk_cell": "50.0", "age": " 30 ", "b_cell": "1e2"})
    assert found(df) == set()
    row = df.first()
    assert (row.nk_cell, row.age, row.b_cell) == (50, 30, 100)


def test_rules_are_reported_in_order(wide_frame):
    df = wide_frame({"b_cell": -5, "sample": "z"}, {"monocyte": -1, "sample": "a"},
                    {"b_cell": -2, "sample": "m"}, {"sample": "q", "sex": "F", **COUNTS})
    first = checks.first_violation(checks.violations(df, CLINICAL))
    # Component order comes before the sample's.
    assert (first["rule"], first["column"], first["key"]) == ("negative_count", "b_cell", "m")


def test_drift_reports_first_column_of_first_subject(wide_frame):
    df = wide_frame({}, {"sample": "b", "age": 31, "sex": "F"},
                    {"sample": "c", "subject": "a-03"},
                    {"sample": "d", "subject": "a-03", "response": None})
    assert {(r, k, c) for r, k, c in found(df)} == {
        ("subject_drift", "p-17", "age"), ("subject_drift", "p-17", "sex"),
        ("subject_drift", "a-03", "response")}
    first = checks.first_violation(checks.violations(df, CLINICAL))
    assert (first["key"], first["column"]) == ("a-03", "response")


def test_blank_is_a_value_for_response_only(wide_frame):
    same = wide_frame({"response": None}, {"sample": "b", "response": None})
    assert found(same) == set()
    other = wide_frame({"sex": None}, {"sample": "b"})
    assert found(other) == set()


def test_every_violation_is_listed(wide_frame):
    df = wide_frame({"b_cell": -1, "age": "x"}, {"sample": "v-204", "subject": "s2", **COUNTS})
    assert {r for r, _, _ in found(df)} == {
        "duplicate_sample", "negative_count", "zero_total", "not_integer"}


@pytest.fixture
def tables(wide_frame):
    return normalize(wide_frame({}, {"sample": "smp2", "time_from_treatment_start": 7}), CLINICAL)


def test_tables_of_valid_input_break_no_rule(tables):
    assert checks.table_violations(tables).count() == 0


@pytest.mark.parametrize("table,row,expected", [
    ("samples", ("lost", "nobody", "PBMC", 0), ("samples", "orphan", "nobody")),
    ("samples", ("v-204", "p-17", "PBMC", 0), ("samples", "duplicate_key", "v-204")),
    ("subjects", ("sub9", "no_project", None, 1, None, None, None),
     ("subjects", "orphan", "no_project")),
    ("cell_counts", ("v-204", "extra", -1), ("cell_counts", "negative_count", "v-204|extra")),
    ("cell_counts", ("v-204", "b_cell", 1), ("cell_counts", "duplicate_key", "v-204|b_cell")),
    ("cell_counts", ("ghost", "b_cell", 1), ("cell_counts", "orphan", "ghost")),
])
def test_table_rules(spark, tables, table, row, expected):
    extra = spark.createDataFrame([row], tables[table].schema)
    broken = {**tables, table: tables[table].unionByName(extra)}
    got = {(r.table, r.rule, r.key) for r in checks.table_violations(broken).collect()}
    assert got == {expected}


def test_missing_values(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), ("b", None)], "x string, y int")
    assert {tuple(r) for r in checks.missing_values(df, ["x", "y"]).collect()} == {
        ("x", 1), ("y", 2)}


def test_orphans_ignore_null(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "id string")
    assert [tuple(r) for r in checks.orphans(child, "k", parent, "id").collect()] == [("b", 2)]


def test_completeness_closure_and_vocabulary(spark):
    df = spark.createDataFrame([("s1", "x", 60.0), ("s1", "y", 40.0), ("s2", "x", 99.0)],
                               "sample string, population string, percentage double")
    assert [tuple(r) for r in checks.incomplete_entities(df, "sample", 2).collect()] == [("s2", 1)]
    assert [r.sample for r in checks.open_compositions(df).collect()] == ["s2"]
    assert [r.population for r in checks.unexpected_values(df, "population", ["x"]).collect()] == ["y"]
    assert [r.population for r in checks.absent_values(df, "population", ["x", "z"]).collect()] == ["z"]


def test_join_cardinality(spark):
    three, two = spark.range(3), spark.range(2)
    assert checks.join_cardinality(three, three).first().complete
    assert not checks.join_cardinality(three, two).first().complete


def test_empty_tables(spark):
    empty = empty_tables(spark)
    assert checks.table_violations(empty).count() == 0
    assert all(df.count() == 0 for df in empty.values()) and len(empty) == 4


def test_all_rules_in_one_scan(spark, wide_frame, tmp_path):
    rows = [{"sample": "a"}, {"sample": "a", "subject": "q"}, {"sample": "b", "subject": "q", "sex": "F"},
            {"sample": None, "age": "x", "b_cell": -3}, {"sample": None, "age": "x", "b_cell": -3},
            {"sample": "c", "response": None}, {"sample": "d", "subject": None},
            {"sample": "e", "condition": None}, {"sample": "f", **COUNTS}]
    df = wide_frame(*rows)
    df.write.parquet(str(tmp_path / "wide"))
    stored = spark.read.schema(df.schema).parquet(str(tmp_path / "wide"))
    found = checks.violations(stored, CLINICAL)
    assert sorted((r.rule, r.key, r.column, r.detail) for r in found.collect() if r.key) == [
        ("duplicate_sample", "a", "sample", "2"), ("missing_key", "d", "subject", None),
        ("subject_drift", "p-17", "response", None), ("subject_drift", "q", "sex", None),
        ("zero_total", "f", None, None)]
    without_key = sorted((r.rule, r.column, r.detail) for r in found.collect() if not r.key)
    assert without_key == [("duplicate_sample", "sample", "2")] + [
        row for row in [("missing_key", "sample", None), ("negative_count", "b_cell", "-3"),
                        ("not_integer", "age", None)] for _ in range(2)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("HashAggregate") + plan.count(
        "SortAggregate") + plan.count("ObjectHashAggregate") == 2


def test_a_finding_is_aggregated_without_what_follows_from_it(spark, wide_frame):
    """Rule names, keys and positions are added behind the shuffle."""
    df = checks.violations(wide_frame({"b_cell": -1}), CLINICAL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    before = plan[plan.index("Aggregate"):]
    assert "'rule'" not in before and "negative_count" not in before and ", rule," not in before
    assert [tuple(r) for r in df.select(*checks.VIOLATION_COLUMNS).collect()] == [
        ("negative_count", "v-204", "b_cell", "-1")]


@pytest.mark.parametrize("name", ["malformed_rows", "input_violations", "first_violation",
                                  "refused_load", "table_violations"])
def test_rows_of_checks_are_spread_by_their_number(spark, tmp_path, star_folder, monkeypatch, name):
    """A task's share of almost unique keys is bounded by rows, not by the files' bytes."""
    few, made = QUERIES[name](spark, star_folder).collect(), []
    monkeypatch.setattr(skew, "ROWS_HELD", 7)
    real = skew.parts_of
    monkeypatch.setattr(skew, "parts_of", lambda *a: made.append(real(*a)) or made[-1])
    many = QUERIES[name](spark, star_folder).collect()
    assert sorted(map(str, few)) == sorted(map(str, many)) and few and max(made) > 4


@pytest.fixture
def star_folder(spark, tmp_path):
    made = {
        "nation": spark.range(3).selectExpr("id AS n_nationkey", "concat('n', id) AS n_name"),
        "customer": spark.range(10).selectExpr(
            "id AS c_custkey", "id % 3 AS c_nationkey", "id * 1000D AS c_acctbal",
            "'BUILDING' AS c_mktsegment"),
        "orders": spark.range(30).selectExpr(
            "id AS o_orderkey", "id % 10 AS o_custkey", "'O' AS o_orderstatus"),
        "lineitem": spark.range(40).selectExpr(
            "id % 20 AS l_orderkey", "id AS l_partkey", "id % 4 AS l_suppkey",
            "CAST(id % 3 AS INT) AS l_linenumber", "id % 51 + 0D AS l_quantity",
            "id * 100D AS l_extendedprice", "0.04D AS l_discount", "0.02D AS l_tax",
            "IF(id % 2 = 0, 'A', 'R') AS l_returnflag", "'F' AS l_linestatus")}
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_rebuilt_tables_are_made_from_stored_rows(spark, star_folder, monkeypatch):
    plans, real = [], norm.normalize
    def seen(df, study):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, study)
    monkeypatch.setattr(norm, "normalize", seen)
    rows = QUERIES["rebuild_tables"](spark, star_folder).collect()
    assert len(plans) == 1 and "Join" not in plans[0] and "Aggregate" not in plans[0]
    assert sum(r.name == "samples" for r in rows) == 20


def test_ordered_frequencies_sort_once_in_parts_by_rows(spark, star_folder, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_HELD", 20)
    made = ordered_frequencies(star.tables(spark, star_folder), star.STAR)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan[:plan.index("Window")].count("Sort [") == 0
    keys = [(r.sample, star.STAR.components.index(r.population)) for r in made.collect()]
    assert keys == sorted(keys) and len(keys) == 180
    assert made.rdd.getNumPartitions() == 9
