import pytest

from tallyfold import CLINICAL
from tallyfold.functions.scalars import canonical_order
from tallyfold.operators.composition import (
    FREQUENCY_COLUMNS, composition, composition_of_events, composition_of_wide)

ROWS = [("s1", "monocyte", 30), ("s1", "b_cell", 70), ("s2", "b_cell", 0), ("s2", "monocyte", 0),
        ("s3", "other", 1), ("s3", "b_cell", 2)]


@pytest.fixture
def counts(spark):
    return spark.createDataFrame(ROWS, "sample string, population string, count bigint")


@pytest.mark.parametrize("listed", [True, False])
def test_percentages_and_zero_total(counts, listed):
    rows = composition(counts, one_row_per_component=listed).collect()
    got = {(r.sample, r.population): (r.total_count, r.percentage) for r in rows}
    assert got["s1", "b_cell"] == (100, 70.0) and got["s1", "monocyte"] == (100, 30.0)
    assert got["s2", "b_cell"] == (0, 0.0)
    assert got["s3", "b_cell"] == (3, 2 / 3 * 100)
    assert len(rows) == len(ROWS)


def test_columns(counts):
    assert tuple(composition(counts).columns) == FREQUENCY_COLUMNS


def test_heavy_and_null_entities(spark):
    rows = [("hot", f"c{i}", 1) for i in range(200)] + [(None, f"c{i}", 2) for i in range(150)]
    rows += [(f"s{i}", "c0", i) for i in range(1500)]
    df = spark.createDataFrame(rows, "sample string, population string, count bigint")
    window, joined = composition(df, one_row_per_component=True), composition(df)
    assert sorted(map(str, window.collect())) == sorted(map(str, joined.collect()))
    assert "Window" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_canonical_order_puts_unknown_components_last(counts):
    ordered = composition(counts).orderBy(
        *canonical_order("sample", "population", CLINICAL.components))
    assert [(r.sample, r.population) for r in ordered.collect()] == [
        ("s1", "b_cell"), ("s1", "monocyte"), ("s2", "b_cell"), ("s2", "monocyte"),
        ("s3", "b_cell"), ("s3", "other")]


def test_wide_form_needs_no_shuffle_and_agrees(spark):
    wide = spark.createDataFrame([("s1", "x", 70, 30), ("s2", "y", 0, 0)],
                                 "sample string, kept string, b_cell bigint, monocyte bigint")
    out = composition_of_wide(wide, ["b_cell", "monocyte"], keep=["kept"])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {(r.sample, r.kept, r.population, r.percentage) for r in out.collect()} == {
        ("s1", "x", "b_cell", 70.0), ("s1", "x", "monocyte", 30.0), ("s2", "y", "b_cell", 0.0),
        ("s2", "y", "monocyte", 0.0)}


def test_events(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "b")], "u int, t string")
    assert {tuple(r) for r in composition_of_events(df, "u", "t").collect()} == {
        (1, 3, "a", 2, 2 / 3 * 100), (1, 3, "b", 1, 1 / 3 * 100), (2, 1, "b", 1, 100.0)}


def test_closure(counts):
    sums = {}
    for r in composition(counts).collect():
        sums[r.sample] = sums.get(r.sample, 0.0) + r.percentage
    assert sums["s1"] == pytest.approx(100) and sums["s3"] == pytest.approx(100)
    assert sums["s2"] == 0.0
