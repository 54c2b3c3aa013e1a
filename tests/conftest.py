"""One local session for all tests."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


def local_session() -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]").appName("ontime-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", "/tmp/ontime-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark():
    yield local_session()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
