import os

import pytest

import __spark_entry__ as entry_points
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
# every module of queries is represented; the whole list is compared by tests/oracle_check.py
SAMPLE = [
    "ab_analysis", "fisher_exact", "latest_runs", "scorecard_verdict", "certification_levels", "scan_gate", "security_findings",
    "broken_references", "case_rewards", "task_run_totals", "token_usage", "validation_errors", "trial_files", "stored_reports",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_flagship_query(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "recommendation" in df.columns


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert len(entry_points.queries()) > 100


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, name):
    ok, n, _, note = compare(spark, duck(SF), SF, name)
    assert ok, note
    assert n > 0
