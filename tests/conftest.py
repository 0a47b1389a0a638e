from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

SF_DIR = "/root/testdata/sf0.001"


def make_session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("tidetable-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidetable-tests-"))
        .getOrCreate()
    )


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
