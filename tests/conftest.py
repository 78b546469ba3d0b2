import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from wayfarer.session import LOCAL_DEFAULTS, checkpoint_dir
    b = SparkSession.builder.master("local[*]").appName("wayfarer-tests")
    for k, v in LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="wayfarer-warehouse-"))
    s = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="wayfarer-test-")
