import random
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyfold import CLINICAL
from tallyfold.operators.normalize import normalize
from tallyfold.plans import jobs
from tallyfold.plans.summary import significance_summary
from tallyfold.sources.tables import published_run, read_optional
from tallyfold.sources.wide_csv import InvalidInput
from tallyfold.study import STATS_COLUMNS
from tests.conftest import BASE_ROW
from tests.test_input import write_csv


def study_rows(n_subjects=60, seed=1):
    """A small study whose responders have clearly more B cells at day 7."""
    rng = random.Random(seed)
    rows = []
    for i in range(n_subjects):
        ill = i % 6 != 5
        subject = {
            "project": f"prj{i % 3 + 1}", "subject": f"sbj{i:03d}",
            "condition": "melanoma" if ill else "healthy", "age": 30 + i % 40,
            "sex": "FM"[i % 2], "treatment": "miraclib" if ill else "none",
            "response": ("yes" if i % 4 < 2 else "no") if ill else None}
        for time in (0, 7, 14):
            row = {**BASE_ROW, **subject, "sample": f"smp{len(rows):04d}",
                   "sample_type": "PBMC" if i % 10 else "WB", "time_from_treatment_start": time}
            row.update({c: rng.randint(800, 1200) for c in CLINICAL.components})
            if subject["response"] == "yes" and time == 7:
                row["b_cell"] += 900
            rows.append(row)
    return rows


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("study")
    rows = study_rows()
    made = jobs.run_study(spark, write_csv(out / "in.csv", rows), str(out))
    return out, rows, made


def results(spark, out):
    return Path(published_run(spark, str(out / "results")))


def kept(rows):
    return [r for r in rows if r["condition"] == "melanoma" and r["treatment"] == "miraclib"
            and r["sample_type"] == "PBMC" and r["response"]]


def test_tables(spark, run):
    out, rows, _ = run
    tables = jobs.current_tables(spark, str(out))
    assert {k: v.count() for k, v in tables.items()} == {
        "projects": 3, "subjects": 60, "samples": 180, "cell_counts": 900, "wide": 180}


def test_frequencies(run):
    _, rows, made = run
    got = made["cell_frequencies"].collect()
    assert len(got) == 900
    assert [(r["sample"], r.population) for r in got[:6]] == [
        *[("smp0000", c) for c in CLINICAL.components], ("smp0001", "b_cell")]
    total = sum(rows[0][c] for c in CLINICAL.components)
    assert (got[0].total_count, got[0].percentage) == (total, rows[0]["b_cell"] / total * 100)


def test_frequency_files_are_in_order(spark, run):
    out, _, made = run
    lines = []
    for part in sorted(results(spark, out).glob("cell_frequencies/part-*")):
        lines += part.read_text().splitlines()[1:]
    samples = [line.split(",")[0] for line in lines]
    assert samples == sorted(samples) and len(samples) == 900


def test_statistics(spark, run):
    out, rows, made = run
    stats = made["stats"]
    assert stats.count() == 25 and set(STATS_COLUMNS) <= set(stats.columns)
    row = stats.where("scope = 'pooled' AND population = 'b_cell'").first()
    assert row.n_responder + row.n_nonresponder == len(kept(rows))
    strong = stats.where("scope = 't=7' AND population = 'b_cell'").first()
    assert strong.significant_primary and strong.significant_high_confidence
    assert strong.rank_biserial > 0.8 and strong.timepoint == 7


def test_summary(spark, run):
    out, rows, _ = run
    text = "\n".join(r.value for r in spark.read.text(str(results(spark, out) / "stats_summary")).collect())
    subjects = {r["subject"] for r in kept(rows)}
    headings = [line for line in text.split("\n") if line.startswith("## ")]
    assert headings == [
        f"## Primary analysis — baseline (n={len(subjects)} subjects, one PBMC sample per subject "
        "at time=0)",
        f"## Sensitivity — pooled (n={len(kept(rows))} samples, {len(subjects)} subjects × 3 "
        "timepoints)",
        f"## Exploratory — per-timepoint (n={len(subjects)} each at t=0, 7, 14)",
        "## High-confidence cross-check"]
    assert "(t=7) b_cell: mwu_p_bh=" in text
    assert "No baseline population satisfied both tests at adjusted p < 0.05." in text


def test_cohort(run):
    _, rows, made = run
    base = [r for r in rows if r["condition"] == "melanoma" and r["sample_type"] == "PBMC"
            and r["time_from_treatment_start"] == 0]
    assert made["part4_baseline_samples"].count() == len(base)
    by_response = {r.response: r.n_subjects for r in made["part4_by_response"].collect()}
    assert by_response == {k: sum(r["response"] == k for r in base) for k in ("yes", "no")}
    assert sum(r.n_samples for r in made["part4_by_project"].collect()) == len(base)


def test_boxplots(run):
    _, _, made = run
    assert made["boxplots"].count() == 10 and made["boxplots_per_timepoint"].count() == 30
    assert made["boxplots"].first().title == "B Cell"


def test_rerun_replaces_the_results(spark, run):
    out, rows, made = run
    before = sorted(map(str, made["stats"].collect()))
    again = jobs.analyse(jobs.current_tables(spark, str(out)), str(out / "results"))
    assert sorted(map(str, again["stats"].collect())) == before


def test_invalid_input_leaves_the_published_tables(spark, run, tmp_path):
    out, rows, _ = run
    bad = [{**rows[0], "b_cell": -4}, *rows[1:]]
    with pytest.raises(InvalidInput, match="negative count"):
        jobs.load(spark, write_csv(tmp_path / "bad.csv", bad), str(out))
    assert jobs.current_tables(spark, str(out))["samples"].count() == 180


def test_no_tables_yet(spark, tmp_path):
    assert jobs.current_tables(spark, str(tmp_path)) is None
    assert read_optional(spark, str(tmp_path / "results")) is None


def test_summary_lists_findings_and_falls_back_to_sentences(spark):
    def stat(scope, timepoint, population, primary, high):
        return (scope, timepoint, population, 0.012345678, 0.1234, 0.5, primary, high)

    schema = ("scope string, timepoint int, population string, mwu_p_bh double, "
              "rank_biserial double, median_difference double, significant_primary boolean, "
              "significant_high_confidence boolean")
    profile = spark.createDataFrame([("pooled", 30, 10), ("t=0", 10, 10), ("t=7", 11, 10),
                                     ("t=14", 9, 9)],
                                    "scope string, n_samples bigint, n_subjects bigint")
    some = spark.createDataFrame(
        [stat("baseline", None, "nk_cell", True, True), stat("pooled", None, "b_cell", True, False),
         stat("baseline", None, "b_cell", True, True), stat("t=14", 14, "b_cell", True, False)],
        schema)
    text = significance_summary(some, profile, CLINICAL)
    line = "mwu_p_bh=0.01235, rank_biserial=0.123"
    assert (f"b_cell: {line}, median_difference=0.500.\n"
            f"nk_cell: {line}, median_difference=0.500.") in text
    assert f"\nb_cell: {line}.\n" in text and "(t=14) b_cell: mwu_p_bh=0.01235, rb=0.123" in text
    assert "(n=10, 11, 9 at t=0, 7, 14)" in text
    assert text.endswith("Baseline populations satisfying both tests at adjusted p < 0.05: "
                         "b_cell, nk_cell.")
    none = significance_summary(some.where("false"), profile, CLINICAL)
    assert none.count("No population reached") == 3 and none.count("---") == 3
    assert none.index("## Primary analysis") < none.index("## Sensitivity") < none.index(
        "## Exploratory") < none.index("## High-confidence")


def runs(out, part):
    return sorted(p.name for p in (out / part).glob("run=*"))


def test_a_failed_load_leaves_no_copy_and_old_runs_go(spark, tmp_path):
    rows = study_rows(12)
    for _ in range(3):
        jobs.load(spark, write_csv(tmp_path / "in.csv", rows), str(tmp_path), keep_runs=2)
    before = runs(tmp_path, "tables")
    assert len(before) == 2
    with pytest.raises(InvalidInput):
        jobs.load(spark, write_csv(tmp_path / "bad.csv", [{**rows[0], "b_cell": -1}]),
                  str(tmp_path))
    assert runs(tmp_path, "tables") == before


@pytest.mark.parametrize("with_wide", [True, False])
def test_a_lost_count_row_stops_the_analysis_before_results_change(spark, tmp_path, with_wide):
    rows = study_rows(24)
    tables = jobs.load(spark, write_csv(tmp_path / "in.csv", rows), str(tmp_path))
    if not with_wide:
        del tables["wide"]
    out = str(tmp_path / "results")
    first = jobs.analyse(tables, out)
    published, kept_rows = published_run(spark, out), first["stats"].collect()
    if not with_wide:
        broken = {**tables, "cell_counts": tables["cell_counts"].where(
            f"NOT (sample_id = '{kept(rows)[0]['sample']}' AND population = 'b_cell')")}
        with pytest.raises(ValueError, match=kept(rows)[0]["sample"]):
            jobs.analyse(broken, out)
    assert published_run(spark, out) == published and len(runs(tmp_path, "results")) == 1
    assert first["stats"].collect() == kept_rows


def test_wide_rows_and_tables_give_the_same_results(spark, run, tmp_path):
    out, _, made = run
    tables = jobs.current_tables(spark, str(out))
    del tables["wide"]
    again = jobs.analyse(tables, str(tmp_path / "results"))
    for name, df in made.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, again[name].collect())), name
        assert (out / "results/run=").as_posix() in df.inputFiles()[0]


def test_saved_statistics_by_scope(spark, run, tmp_path):
    out, _, made = run
    one = jobs.saved_statistics(spark, str(out / "results"), "baseline")
    assert one.columns == list(STATS_COLUMNS) and one.count() == 5
    timed = jobs.saved_statistics(spark, str(out / "results"))
    assert timed.columns == ["timepoint", *STATS_COLUMNS] and timed.count() == 15
    with pytest.raises(FileNotFoundError):
        jobs.saved_statistics(spark, str(tmp_path / "none"))


def test_summary_of_other_studies(spark):
    stats = spark.createDataFrame([], "scope string, timepoint int, population string, "
                                  "mwu_p_bh double, significant_primary boolean, "
                                  "significant_high_confidence boolean")
    profile = spark.createDataFrame([], "scope string, n_samples bigint, n_subjects bigint")
    two = replace(CLINICAL, timepoints=(0, 7), alpha=0.01, cohort={"condition": "melanoma"})
    text = significance_summary(stats, profile, two)
    assert "A subject's two samples are not independent" in text
    assert "Two separate" in text and "(`mwu_p_bh < 0.01`)" in text and "0.05" not in text
    assert "one sample per subject" in text and "in melanoma patients: responders" in text
    bare = significance_summary(stats, profile, replace(CLINICAL, cohort={}))
    assert "in patients: responders against non-responders" in bare and "with the sample" in bare


def test_lost_and_repeated_component_rows_do_not_cancel_out(spark, wide_frame):
    wide = wide_frame({"sample": "a"}, {"sample": "b", "subject": "q"})
    tables = {"wide": wide}
    cohort = jobs.cohort_frequencies(tables, CLINICAL)
    metadata = jobs.metadata_of(tables)
    jobs.require_whole_cohort(cohort, metadata, CLINICAL)
    lost = cohort.where("NOT (sample = 'a' AND population = 'b_cell')")
    again = cohort.where("sample = 'b' AND population = 'monocyte'")
    same_sample = cohort.where("sample = 'a' AND population = 'monocyte'")
    other = again.withColumn("population", F.lit("other"))
    for changed in (lost, lost.unionAll(again), lost.unionAll(same_sample), lost.unionAll(other),
                    cohort.unionAll(other)):
        with pytest.raises(ValueError, match="cohort"):
            jobs.require_whole_cohort(changed, metadata, CLINICAL)


def test_the_cohort_is_checked_while_it_is_written(spark, wide_frame, tmp_path):
    wide = wide_frame({"sample": "a"}, {"sample": "b", "subject": "q"},
                      {"sample": "c", "subject": "r", "response": None})
    wide.write.parquet(str(tmp_path / "wide"))
    made = normalize(wide, CLINICAL)
    for name, table in made.items():
        table.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in (*made, "wide")}
    long = {name: stored[name] for name in made}

    def agrees(tables, name, change=lambda df: df):
        check = jobs.CohortCheck(CLINICAL)
        rows = check.rows(change(jobs.cohort_frequencies(tables, CLINICAL, check)))
        rows.write.parquet(str(tmp_path / "out" / name))
        return check.agrees()

    assert agrees({"wide": stored["wide"]}, "wide") and agrees(long, "long")
    lost = lambda df: df.where("NOT (sample = 'a' AND population = 'b_cell')")
    again = lambda df: lost(df).unionAll(df.where("sample = 'b' AND population = 'monocyte'"))
    assert not agrees(long, "lost", lost) and not agrees(long, "again", again)
    doubled = {**long, "cell_counts": long["cell_counts"].unionAll(
        long["cell_counts"].where("population = 'b_cell'"))}
    assert not agrees(doubled, "doubled")
