import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from fleetspark.session import checkpoint_dir, prepare

    s = (SparkSession.builder.master("local[4]").appName("fleetspark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    prepare(s)
    # tests only: the session names no shared folder, so use a fresh scratch one
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="fleetspark-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="fleetspark-run-")


SF_SMALL = "/root/testdata/sf0.001"
