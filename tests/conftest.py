import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("starflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark, tmp_path):
    from starflow.sources.workspace import Workspace

    return Workspace(spark, str(tmp_path))


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def ansi(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(scope="session")
def sf_dir():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip(f"no test data at {path}")
    return path
