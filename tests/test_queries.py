"""Queries against DuckDB on the smallest given tables, and the whole run end to end."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import duckdb
import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from checks.run import TABLES, compare
from checks.tables import tables
from ledgerlark.operators.churn import ForestSettings
from ledgerlark.plans.full_run import run_all
from ledgerlark.sources.driver_tables import REFERENCE_DATE

FOLDER = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()
QUERIES = entry_points.queries()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def verdicts(spark):
    """All comparisons, several at a time: on tables this small most of the time is planning."""
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")

    def verdict(name: str) -> str:
        try:
            return compare(spark, connection.cursor(), QUERIES[name], SQL[name], FOLDER)
        except Exception as error:  # shown by the test of this query
            return repr(error)

    with ThreadPoolExecutor(6) as pool:
        return dict(zip(SQL, pool.map(inheritable_thread_target(spark)(verdict), SQL), strict=True))


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(verdicts, name):
    assert verdicts[name].startswith("ok"), verdicts[name]


def test_whole_run(spark, tmp_path):
    t = tables(spark, FOLDER)
    out = run_all(
        spark, t.dirty_customers, t.dirty_products, t.dirty_orders, t.dirty_items, str(tmp_path), REFERENCE_DATE, ["arrival"],
        ForestSettings(trees=10, depth=4), restarts=1)
    assert out["data_quality_report"].count() == 27
    n = out["customers"].count()
    assert n == out["rfm_features"].count() == out["customer_features"].count() == out["customer_segments"].count()
    assert out["extracts/customer_360"].count() == n == out["extracts/customer_dashboard"].count()
    total = out["order_items"].agg(F.sum("line_total")).first()[0]
    assert float(total) == pytest.approx(out["report/headline"].first().total_revenue)
    for part in ("category_performance", "regional_performance"):
        assert out[f"report/{part}"].agg(F.sum("revenue")).first()[0] == pytest.approx(float(total))
    summary = out["report/churn_summary"].first()
    assert summary.high_risk_count + summary.medium_risk_count + summary.low_risk_count == summary.scored_customers
    assert out["report/segment_summary"].agg(F.sum("customers")).first()[0] == n
