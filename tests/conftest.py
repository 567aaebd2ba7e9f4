import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    shared = "file://" + tempfile.mkdtemp(prefix="run-")
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
               .config("spark.checkpoint.dir", shared).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new local folder, left in place."""
    return tempfile.mkdtemp(prefix="run-")
