from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recordkit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    )
    yield session
    session.stop()


@pytest.fixture
def partitions(spark):
    """Set the number of shuffle partitions for one test."""
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def choose(n: int) -> None:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))

    yield choose
    spark.conf.set("spark.sql.shuffle.partitions", before)
