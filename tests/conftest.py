import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from skylight.session import DEFAULT_CONF, apply_defaults

    builder = (SparkSession.builder.master("local[4]").appName("skylight-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="skylight-test-ckpt-")))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    apply_defaults(s)
    yield s
    s.stop()
