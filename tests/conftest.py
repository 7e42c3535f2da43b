import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from skywave.session import BASE_CONF, checkpoint_root, ensure_utc
    b = SparkSession.builder.master("local[4]").appName("skywave-tests").config("spark.sql.shuffle.partitions", "8")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_utc(s)
    if not s.conf.get("spark.checkpoint.dir", None):      # tests only: set one where it is unset
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="skywave-test-ckpt-"))
    checkpoint_root(s)
    yield s
    s.stop()
