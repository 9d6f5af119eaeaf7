"""Every registered query equals its DuckDB oracle (sf0.001 for speed; the
driver's check runs the same pairs at sf0.01, see check_oracle.py)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from harness import compare

SQL = E.oracle_sql()


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, duck_small, key):
    df = E.queries()[key](spark, SF_SMALL)
    problems, _, _ = compare(df, duck_small, SQL[key])
    assert not problems, problems


def test_every_query_runs(spark):
    for key, fn in E.queries().items():
        if key not in SQL:
            assert fn(spark, SF_SMALL).count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["metric_type", "total_readings", "avg_value", "std_dev", "min_value",
                          "max_value", "abnormal_count", "abnormal_percentage"]
