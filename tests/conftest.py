import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from feedlens.session import DEFAULT_CONF, ensure_checkpoint_dir

    b = (SparkSession.builder.master("local[*]").appName("feedlens-tests")
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="feedlens-test-")


@pytest.fixture(scope="session")
def actions001(spark):
    from feedlens.sources.actions import load_fixture
    return load_fixture(spark, SF001)
