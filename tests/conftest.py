import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="claimsight-test-")
    s = (SparkSession.builder.master("local[4]").appName("claimsight-tests")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", ckpt).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture(scope="session")
def rel(spark):
    from claimsight.sources.mapping import Relations
    return Relations(spark, SF)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="claimsight-run-")
