import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from parcelmart.session import RESULT_SETTINGS, SCALE_SETTINGS

    ckpt = tempfile.mkdtemp(prefix="parcelmart-test-")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("parcelmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", ckpt)
    )
    for k, v in {**RESULT_SETTINGS, **SCALE_SETTINGS}.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from tests.oracle import duck

    return duck(SF_SMALL)
