import random

import numpy as np
import pytest

from tallyfold import CLINICAL
from tallyfold.operators import cohort as cohorts, explore as views
from tallyfold.operators.boxplot import (
    annotate, boxplot_input, boxplot_order, boxplot_tables, formatted_stats, study_boxes)
from tallyfold.operators.normalize import normalize, sample_metadata
from tallyfold.study import COHORT_COLUMNS, TIME

META = ("sample string, subject string, project string, condition string, age int, sex string, "
        f"treatment string, response string, sample_type string, {TIME} int")


@pytest.fixture(scope="module")
def metadata(spark):
    def row(sample, subject, project="prj1", response="yes", sex="F", time=0,
            condition="melanoma", treatment="miraclib", sample_type="PBMC"):
        return (sample, subject, project, condition, 40, sex, treatment, response, sample_type,
                time)

    return spark.createDataFrame([
        row("s3", "a"), row("s1", "a"), row("s2", "b", "prj3", "no", "M"),
        row("s4", "c", response=None), row("s5", "d", "prj3", "no", "M", time=7),
        row("s6", "e", condition="healthy"), row("s7", "f", treatment="none"),
        row("s8", "g", sample_type="WB"), row("s9", "h", "prj3", "maybe")], META)


def test_comparison_cohort_needs_a_known_response(metadata):
    chosen = cohorts.comparison_cohort(metadata, CLINICAL)
    assert {r["sample"] for r in chosen.collect()} == {"s1", "s2", "s3", "s5"}


def test_baseline_cohort_does_not(metadata):
    chosen = cohorts.baseline_cohort(metadata, CLINICAL)
    assert tuple(chosen.columns) == COHORT_COLUMNS
    assert sorted(r["sample"] for r in chosen.collect()) == ["s1", "s2", "s3", "s4", "s9"]


def test_breakdowns(metadata):
    chosen = cohorts.baseline_cohort(metadata, CLINICAL)
    assert [tuple(r) for r in cohorts.breakdown(chosen, "project").collect()] == [
        ("prj1", 3), ("prj3", 2)]
    by_response = cohorts.breakdown(chosen, "response", one_per="subject")
    assert by_response.columns == ["response", "n_subjects"]
    # Subject a counts once, subject c has no response.
    assert [tuple(r) for r in by_response.collect()] == [("maybe", 1), ("no", 1), ("yes", 1)]
    assert [tuple(r) for r in cohorts.breakdown(chosen, "sex", one_per="subject").collect()] == [
        ("F", 3), ("M", 1)]
    assert cohorts.subject_total(by_response).first()[0] == 3


def test_a_subject_counts_under_its_first_row_even_if_that_is_null(spark):
    df = spark.createDataFrame([("s1", "a", None), ("s2", "a", "yes"), ("s3", "b", "no")],
                               "sample string, subject string, response string")
    assert [tuple(r) for r in cohorts.breakdown(df, "response", one_per="subject").collect()] == [
        ("no", 1)]


def test_empty_cohort_keeps_the_columns(metadata):
    empty = metadata.where("false")
    for key, one_per in (("project", None), ("response", "subject"), ("sex", "subject")):
        df = cohorts.breakdown(empty, key, one_per=one_per)
        assert df.columns == [key, "n_subjects" if one_per else "n_samples"] and df.count() == 0
    total = cohorts.subject_total(cohorts.breakdown(empty, "sex", one_per="subject"))
    assert total.first()[0] == 0


def test_profile(metadata):
    chosen = cohorts.comparison_cohort(metadata, CLINICAL)
    got = {r.scope: tuple(r)[1:] for r in cohorts.cohort_profile(chosen, CLINICAL).collect()}
    assert got == {"pooled": (4, 3, 1, 2), "t=0": (3, 2, 1, 1), "t=7": (1, 1, 0, 1)}


# --- box plots ----------------------------------------------------------------------------


def box(values):
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = [v for v in values if low <= v <= high]
    return (len(values), min([v for v in values if v >= low] + [q1]), q1, median, q3,
            max([v for v in values if v <= high] + [q3]), len(values) - len(inside))


@pytest.mark.parametrize("most_inside", [3, 10 ** 6])
def test_boxes_against_numpy(spark, most_inside):
    rng = random.Random(4)
    rows = [(k, rng.choice([0.0, round(rng.gauss(10, 2), 1), rng.gauss(10, 30)]))
            for k in ("x", "y") for _ in range(150)] + [("z", 1.0), ("left out", 5.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    summary, outliers = boxplot_tables(df, {"k": ["x", "y", "z"]}, "v",
                                       most_inside=most_inside)
    got = {r.k: tuple(r)[1:] for r in summary.collect()}
    assert set(got) == {"x", "y", "z"}
    for key, row in got.items():
        assert row == pytest.approx(box([v for k, v in rows if k == key]))
    n = {}
    for r in outliers.collect():
        n[r.k] = n.get(r.k, 0) + r.n
    assert n == {k: row[-1] for k, row in got.items() if row[-1]}


def test_whisker_never_ends_inside_the_box(spark):
    # The quartiles are interpolated past every value that lies inside the fences.
    values = [0.0, 0.0, 0.0, 10.0]
    df = spark.createDataFrame([("x", v) for v in values], "k string, v double")
    summary, _ = boxplot_tables(df, {"k": ["x"]}, "v")
    assert tuple(summary.first())[1:] == pytest.approx(box(values))
    assert summary.first().whisker_high == summary.first().q3 == 2.5


@pytest.fixture
def cohort_rows(spark):
    rng = random.Random(8)
    rows = [(p, rng.random() * 50, response, time) for p in CLINICAL.components
            for response in ("yes", "no") for time in (0, 7, 14) for _ in range(6)]
    return spark.createDataFrame(rows, f"population string, percentage double, response string, "
                                       f"{TIME} int")


def test_boxes_per_component_group_and_time(cohort_rows):
    labelled = boxplot_input(cohort_rows, CLINICAL)
    assert {r.response_label for r in labelled.select("response_label").distinct().collect()} == {
        "Responder", "Non-responder"}
    plain, _ = study_boxes(cohort_rows, CLINICAL)
    timed, _ = study_boxes(cohort_rows, CLINICAL, by_time=True)
    assert plain.count() == 10 and timed.count() == 30
    rows = timed.orderBy(*boxplot_order(CLINICAL, by_time=True)).collect()
    assert [(r.population, r[TIME], r.response_label) for r in rows[:3]] == [
        ("b_cell", 0, "Responder"), ("b_cell", 0, "Non-responder"), ("b_cell", 7, "Responder")]


def test_annotations(spark, cohort_rows):
    stats = spark.createDataFrame([("b_cell", 0.01, 0.02, True), ("nk_cell", 0.5, 0.6, False)],
                                  "population string, mwu_p_bh double, t_p_bh double, "
                                  "significant_primary boolean")
    shown = annotate(study_boxes(cohort_rows, CLINICAL)[0], stats, CLINICAL)
    got = {r.population: (r.marker, r.title, r.mwu_p_bh) for r in shown.collect()}
    assert got["b_cell"] == ("**", "B Cell", 0.01) and got["nk_cell"] == ("ns", "NK Cell", 0.5)
    assert got["monocyte"] == (None, "Monocyte", None) and shown.count() == 10


def test_number_formats(spark):
    df = spark.createDataFrame([("a", 0.12345, -0.0499, None)],
                               "population string, mwu_p_bh double, rank_biserial double, "
                               "t_p_bh double")
    assert tuple(formatted_stats(df).first()) == ("a", "0.1235", "-0.050", None)


# --- exploration --------------------------------------------------------------------------


@pytest.fixture
def frequencies(spark):
    return spark.createDataFrame(
        [("Smp1", 8, "b_cell", 1, 12.5), ("smp2", 3, "b_cell", 1, 100 / 3),
         ("x.1", 1, "monocyte", 1, 0.125), (None, 1, "b_cell", 1, 2.675)],
        "sample string, total_count bigint, population string, count bigint, percentage double")


def test_component_choice(frequencies):
    assert views.explore(frequencies, []).count() == 0
    assert views.explore(frequencies, ["b_cell"]).count() == 3


def test_text_filter_is_literal_unless_asked(frequencies):
    names = ["b_cell", "monocyte"]
    assert views.explore(frequencies, names, "SMP").count() == 2
    assert views.explore(frequencies, names, ".").count() == 1
    assert views.explore(frequencies, names, "MP.$", regex=True).count() == 2


def test_rounding_is_half_to_even_and_the_export_is_unrounded(frequencies):
    names = ["b_cell", "monocyte"]
    shown = {r["sample"]: r.percentage for r in views.explore(frequencies, names).collect()}
    values = {"Smp1": 12.5, "smp2": 100 / 3, "x.1": 0.125, None: 2.675}
    assert shown == {k: float(np.round(v, 2)) for k, v in values.items()}
    export = views.explore(frequencies, names, rounded=False)
    assert {r["sample"]: r.percentage for r in export.collect()} == values


def test_overview(wide_frame):
    tables = normalize(wide_frame({}, {"sample": "s2", "subject": "sub2", "treatment": None}),
                       CLINICAL)
    got = {(r.metric, r.value): r.n for r in views.overview(tables, CLINICAL).collect()}
    assert got == {
        ("n_samples", None): 2, ("n_subjects", None): 2, ("n_projects", None): 1,
        ("n_populations", None): 5, ("condition", "melanoma"): 2, ("treatment", "miraclib"): 1,
        ("treatment", None): 1, ("sample_type", "PBMC"): 2}
    assert [r[0] for r in views.vocabulary(tables["subjects"], "treatment").collect()] == [
        None, "miraclib"]
    assert sample_metadata(tables).count() == 2


def test_total_range(frequencies):
    assert tuple(views.total_range(frequencies).first()) == (1, 8, 4)
