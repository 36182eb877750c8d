import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="aerolake-test-ckpt-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("aerolake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # a non-UTC session zone: results must not depend on it
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from aerolake.storage import fresh_path

    def make(name="t"):
        return fresh_path(spark, name)

    return make
