import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from deedmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Joins as on tables too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, before)


def values(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]
