from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sitefacts-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tmp_path_factory.mktemp("checkpoints").as_uri())
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def value(spark):
    """Evaluate one expression over named text columns."""

    def run(build, **columns):
        names = list(columns)
        schema = ", ".join(f"{n} string" for n in names)
        row = spark.createDataFrame([tuple(columns.values())], schema)
        return row.select(build(*names).alias("v")).first()["v"]

    return run
