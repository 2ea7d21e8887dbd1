import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from hourwise.session import SESSION_CONF, configure

    b = (SparkSession.builder.master("local[*]").appName("hourwise-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false"))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
