import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="starmart-test-")
    s = (
        SparkSession.builder.master("local[*]").appName("starmart-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .config("spark.checkpoint.dir", f"{base}/checkpoints")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def order_star(spark):
    from starmart.sources.order_lines import OrderLineStar

    return OrderLineStar(spark, SF)
