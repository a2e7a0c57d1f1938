"""What a study is made of: its components, cohort, groups, time points and table schemas.

Operators take column names; a :class:`Study` bundles the driver-side lists that also bound
how many groups an analysis can have (scopes x components x response groups), which is what
makes their small per-group results safe to broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The column names of the study tables, from here to STATS_COLUMNS.
TIME = "time_from_treatment_start"
METADATA = (
    "sample", "subject", "project", "condition", "age", "sex", "treatment", "response",
    "sample_type", TIME,
)
# Per-subject attributes: one value each per subject, checked in this order.
SUBJECT_INVARIANTS = ("project", "condition", "sex", "treatment", "response", "age")
COHORT_COLUMNS = (
    "sample", "subject", "project", "condition", "treatment", "sample_type", TIME, "response",
    "sex",
)
STATS_COLUMNS = (
    "population", "n_responder", "n_nonresponder", "median_responder", "median_nonresponder",
    "mean_responder", "mean_nonresponder", "mean_difference", "median_difference",
    "rank_biserial", "t_stat", "t_p_raw", "t_p_bh", "mwu_stat", "mwu_p_raw", "mwu_p_bh",
    "significant_primary", "significant_high_confidence",
)


_STATS_KINDS = {"population": "string", "n_responder": "bigint", "n_nonresponder": "bigint",
                "significant_primary": "boolean", "significant_high_confidence": "boolean"}
#: Schema of the statistics table.
STATS = "scope string, timepoint int, " + ", ".join(
    f"{name} {_STATS_KINDS.get(name, 'double')}" for name in STATS_COLUMNS)


@dataclass(frozen=True)
class Study:
    """Driver-side description of one study.

    ``components`` is a semantic order, not an alphabetical one: outputs follow it.
    """

    components: tuple[str, ...]
    cohort: dict[str, str]
    labels: dict[str, str] = field(default_factory=dict)
    group_labels: dict[str, str] = field(
        default_factory=lambda: {"yes": "Responder", "no": "Non-responder"})
    timepoints: tuple[int, ...] = (0, 7, 14)
    baseline: int = 0
    alpha: float = 0.05

    @property
    def groups(self) -> tuple[str, ...]:
        """Known response values, the first one being the group whose U is reported."""
        return tuple(self.group_labels)

    @property
    def wide_columns(self) -> tuple[str, ...]:
        return METADATA + self.components


# The immune-cell preset.
CLINICAL = Study(
    components=("b_cell", "cd8_t_cell", "cd4_t_cell", "nk_cell", "monocyte"),
    cohort={"condition": "melanoma", "treatment": "miraclib", "sample_type": "PBMC"},
    labels={
        "b_cell": "B Cell", "cd8_t_cell": "CD8 T Cell", "cd4_t_cell": "CD4 T Cell",
        "nk_cell": "NK Cell", "monocyte": "Monocyte",
    },
)


def _schema(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


TABLES: dict[str, T.StructType] = {
    "projects": _schema(("project_id", T.StringType(), False)),
    "subjects": _schema(
        ("subject_id", T.StringType(), False), ("project_id", T.StringType(), False),
        ("condition", T.StringType(), True), ("age", T.IntegerType(), True),
        ("sex", T.StringType(), True), ("treatment", T.StringType(), True),
        ("response", T.StringType(), True)),
    "samples": _schema(
        ("sample_id", T.StringType(), False), ("subject_id", T.StringType(), False),
        ("sample_type", T.StringType(), True), (TIME, T.IntegerType(), True)),
    "cell_counts": _schema(
        ("sample_id", T.StringType(), False), ("population", T.StringType(), False),
        ("count", T.LongType(), False)),
}
PRIMARY_KEYS = {
    "projects": ("project_id",), "subjects": ("subject_id",), "samples": ("sample_id",),
    "cell_counts": ("sample_id", "population"),
}
FOREIGN_KEYS = (
    ("subjects", "project_id", "projects"),
    ("samples", "subject_id", "subjects"),
    ("cell_counts", "sample_id", "samples"),
)
