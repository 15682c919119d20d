"""Shared pytest fixtures: one Spark session and the edge fixture tables."""

import os
import sys

import pytest

# pyspark.testing imports pandas-on-Spark, which asks for this before a JVM starts
os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from qalens.session import get_session

    # QALENS_TEST_MASTER=local-cluster[2,2,2048] runs the suite on two executor JVMs
    master = os.environ.get("QALENS_TEST_MASTER", "local[4]")
    partitions = int(os.environ.get("QALENS_TEST_PARTITIONS", "8"))
    s = get_session(master, app_name="qalens-tests", shuffle_partitions=partitions)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def site(spark):
    from site_fixture import site_tables

    return site_tables(spark)
