"""Every registered query against its DuckDB twin on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry
from check_oracle import compare, duck
from conftest import SF_SMALL

# the loads of many tiny months are exercised by test_loads instead
SLOW = {"incremental_merge", "stream_merge", "stream_corrected", "run_batch", "repaired_load_hourly"} | {
    "advanced_revenue_windows",
    "advanced_analyses",
    "stored_cleaning_report",
    "stored_pages",
    "stored_rows_per_month",
} | {
    f"incremental_{name}" for name in ("hourly", "zones", "routes", "airports", "summary")
}
# the operators of tests/llm have their own tests
SLOW |= {name for name in entry.oracle_sql() if name.startswith("op")}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, con, name):
    ok, _, message = compare(spark, con, name, SF_SMALL, entry.oracle_sql()[name])
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns[:4] == ["pickup_year", "pickup_month", "pickup_day_of_week", "pickup_hour"]
    assert out.count() > 0
