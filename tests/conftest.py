import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(TESTS))
# Python workers import the package and the test helpers as well
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(TESTS), TESTS])


def make_session() -> SparkSession:
    """Local session; the shared folder a cluster would name is a temporary one here."""
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("offerlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="offerlens-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
