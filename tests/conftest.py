import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = "/root/testdata"


def make_session():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="spark-")
    return (
        SparkSession.builder.master("local[8]").appName("speechlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.local.dir", scratch)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .getOrCreate()
    )


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
