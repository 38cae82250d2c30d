import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ":".join(x for x in (ROOT, os.environ.get("PYTHONPATH", "")) if x)

import pytest  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{DATA}/sf0.001"
