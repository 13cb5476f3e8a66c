import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8,3]")  # a task may fail twice
        .appName("fleetscope-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def medium():
    return str(DATA / "sf0.01")
