import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from snapwise.session import SESSION_DEFAULTS
    b = SparkSession.builder.master("local[*]").appName("snapwise-tests")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8")
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="snapwise-test-ckpt-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="snapwise-test-")
