import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[*]").appName("meteocube-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="meteocube-test-ckpt-"))
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="meteocube-test-")
