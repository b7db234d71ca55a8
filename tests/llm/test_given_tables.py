"""The registered queries on the given tables: against DuckDB where SQL can say it."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry_points  # noqa: E402
from checks.run import TABLES, compare  # noqa: E402
from ledgerlark.llm import queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for name in TABLES:
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return made


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, connection, name):
    verdict = compare(spark, connection, queries.QUERIES[name], queries.ORACLE_SQL[name], FOLDER)
    assert verdict.startswith("ok"), verdict


def test_all_operators_are_registered():
    names = set(entry_points.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in names} and "pipeline" in names
