import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session, release_scratch  # noqa: E402


def make_session() -> SparkSession:
    spark = build_session(
        "local[8]", "millrace-tests", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    release_scratch(session)


@pytest.fixture
def small_groups(spark):
    """Make every group of more than 300 rows too large for one task."""
    spark.conf.set("spark.millrace.groupRows", "300")
    yield
    spark.conf.unset("spark.millrace.groupRows")
