import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyrill.session import local_session, release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def shuffles(spark):
    """Set the number of shuffle partitions for one test."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")

    def to(n: int) -> None:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    yield to
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
