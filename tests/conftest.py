import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerlark.session import build_session, drop_staged  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores="8", partitions=4)
    yield session
    drop_staged(session)
    session.stop()


@pytest.fixture
def wide(spark):
    """Keep several shuffle partitions even for small input."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
