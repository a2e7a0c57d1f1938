"""The plain-text summary of significant findings, made from the small statistics table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyfold.operators.compare import stats_order
from tallyfold.study import Study

# The headings and sentences of the summary, in output order.
BASELINE_HEADING = ("## Primary analysis — baseline (n={subjects} subjects, one {sample} "
                    "per subject at time={baseline})")
BASELINE_ABOUT = (
    "Shares of each cell population in {patients}: responders against non-responders. Every "
    "subject counts once, with the {sample} taken at day {baseline}, before any treatment.")
BASELINE_NONE = ("No population reached the primary significance threshold (`mwu_p_bh < {alpha:g}`) "
                 "at baseline.")
POOLED_HEADING = ("## Sensitivity — pooled (n={samples} samples, {subjects} subjects × "
                  "{n_timepoints} timepoints)")
POOLED_ABOUT = (
    "All samples at once. A subject's {number} samples are not independent of each other, so these "
    "p-values are too small; read them as a check of the direction, not as the result.")
POOLED_NONE = ("No population reached the primary significance threshold (`mwu_p_bh < {alpha:g}`) "
               "in the pooled analysis.")
TIMEPOINT_HEADING = "## Exploratory — per-timepoint (n={sizes} at t={timepoints})"
TIMEPOINT_ABOUT = (
    "{Number} separate comparisons, one for each day, adjusted over the {n_components} populations "
    "of that day. They show whether a difference grows or fades under treatment.")
TIMEPOINT_NONE = "No population reached significance at any individual timepoint."
CROSSCHECK_HEADING = "## High-confidence cross-check"
CROSSCHECK_SOME = "Baseline populations satisfying both tests at adjusted p < {alpha:g}: {names}."
CROSSCHECK_NONE = "No baseline population satisfied both tests at adjusted p < {alpha:g}."
BASELINE_LINE = ("{population}: mwu_p_bh={mwu_p_bh:.4g}, rank_biserial={rank_biserial:.3f}, "
                 "median_difference={median_difference:.3f}.")
POOLED_LINE = "{population}: mwu_p_bh={mwu_p_bh:.4g}, rank_biserial={rank_biserial:.3f}."
TIMEPOINT_LINE = ("(t={timepoint}) {population}: mwu_p_bh={mwu_p_bh:.4g}, "
                  "rb={rank_biserial:.3f}")


NUMBERS = ("no", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")


def study_facts(study: Study) -> dict[str, object]:
    """What the sentences say of a study; cohort columns that it doesn't fix are left unsaid."""
    cohort, count = study.cohort, len(study.timepoints)
    number = NUMBERS[count] if count < len(NUMBERS) else str(count)
    kind = f"{cohort['sample_type']} " if "sample_type" in cohort else ""
    condition = f"{cohort['condition']} " if "condition" in cohort else ""
    treated = f" treated with {cohort['treatment']}" if "treatment" in cohort else ""
    return {"baseline": study.baseline, "alpha": study.alpha, "number": number,
            "Number": number.capitalize(), "sample": f"{kind}sample",
            "patients": f"{condition}patients{treated}", "n_timepoints": count,
            "n_components": len(study.components)}


def significance_summary(stats: DataFrame, profile: DataFrame, study: Study) -> str:
    """Four sections: baseline, pooled, per time point, high-confidence cross-check.

    Collects the statistics (a row per scope and component) and the cohort profile (a row per
    scope), both bounded by the study's lists.
    """
    rows = [row.asDict() for row in stats.orderBy(*stats_order(study)).collect()]
    sizes = {row["scope"]: row.asDict() for row in profile.collect()}
    nothing = {"n_samples": 0, "n_subjects": 0}

    def size(scope: str, what: str) -> int:
        return sizes.get(scope, nothing)[what]

    def lines(template: str, chosen: list[dict], none: str) -> list[str]:
        return [template.format(**row) for row in chosen if row["significant_primary"]] or [none]

    baseline = [row for row in rows if row["scope"] == "baseline"]
    pooled = [row for row in rows if row["scope"] == "pooled"]
    timed = [row for row in rows if row["timepoint"] is not None]
    per_time = [size(f"t={time}", "n_samples") for time in study.timepoints]
    each = f"{per_time[0]} each" if len(set(per_time)) == 1 else ", ".join(map(str, per_time))
    both = [row["population"] for row in baseline if row["significant_high_confidence"]]
    facts = study_facts(study)

    sections = [
        [BASELINE_HEADING.format(subjects=size(f"t={study.baseline}", "n_subjects"), **facts),
         BASELINE_ABOUT.format(**facts),
         "\n".join(lines(BASELINE_LINE, baseline, BASELINE_NONE.format(**facts)))],
        [POOLED_HEADING.format(samples=size("pooled", "n_samples"),
                               subjects=size("pooled", "n_subjects"), **facts),
         POOLED_ABOUT.format(**facts),
         "\n".join(lines(POOLED_LINE, pooled, POOLED_NONE.format(**facts)))],
        [TIMEPOINT_HEADING.format(sizes=each, timepoints=", ".join(map(str, study.timepoints))),
         TIMEPOINT_ABOUT.format(**facts),
         "\n".join(lines(TIMEPOINT_LINE, timed, TIMEPOINT_NONE))],
        [CROSSCHECK_HEADING,
         CROSSCHECK_SOME.format(names=", ".join(both), **facts) if both
         else CROSSCHECK_NONE.format(**facts)],
    ]
    return "\n\n---\n\n".join("\n\n".join(section) for section in sections)
