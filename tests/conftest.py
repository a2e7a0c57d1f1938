import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BASE_ROW = {
    "project": "northern", "subject": "p-17", "condition": "melanoma", "age": 52, "sex": "M",
    "treatment": "miraclib", "response": "yes", "sample": "v-204", "sample_type": "PBMC",
    "time_from_treatment_start": 0, "b_cell": 41, "cd8_t_cell": 333, "cd4_t_cell": 90,
    "nk_cell": 12, "monocyte": 524,
}


@pytest.fixture
def wide_frame(spark):
    """Typed wide DataFrame from partial rows, as the reader makes it."""
    from tallyfold import CLINICAL
    from tallyfold.sources.wide_csv import type_wide

    def make(*overrides):
        rows = [{**BASE_ROW, **o} for o in overrides]
        texts = [tuple(None if r[c] is None else str(r[c]) for c in CLINICAL.wide_columns)
                 for r in rows]
        schema = ", ".join(f"{c} string" for c in CLINICAL.wide_columns)
        return type_wide(spark.createDataFrame(texts, schema), CLINICAL)

    return make
