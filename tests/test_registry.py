import os

import pytest

import __spark_entry__ as contract
from verification.compare import compare, connect
from verification.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    entry = contract.entry(spark)
    assert entry.columns == ["user_id", "total_count", "event_type", "count", "percentage",
                             "component_rank"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, connection, name):
    problem, _, _ = compare(spark, connection, SF_DIR, name)
    assert problem == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_the_shifted_study_has_findings(spark, scale):
    """Flags, markers and finding lines are seen by the comparison with SQL, not empty on both sides."""
    sf_dir = f"/root/testdata/sf{scale}"
    flags = QUERIES["shifted_significant_components"](spark, sf_dir).collect()
    assert {r.scope for r in flags} == {"pooled", "baseline", "t=0", "t=7", "t=14"}
    assert any(r.significant_high_confidence for r in flags)
    shown = QUERIES["shifted_annotated_boxplots"](spark, sf_dir).collect()
    assert "**" in {r.marker for r in shown}
    lines = [r.line for r in QUERIES["shifted_summary_text"](spark, sf_dir).collect()]
    assert any("median_difference=" in line for line in lines)
    assert any(line.startswith("(t=7) ") for line in lines)
    assert any(line.startswith("Baseline populations satisfying both tests") for line in lines)
    every = QUERIES["shifted_statistics"](spark, sf_dir).collect()
    assert len(flags) <= sum(r.significant_primary for r in every)
