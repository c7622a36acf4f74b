import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tickerlake.session import SESSION_DEFAULTS, ensure_checkpoint_dir

    builder = (SparkSession.builder.master("local[*]").appName("tickerlake-tests")
               .config("spark.sql.shuffle.partitions", "8"))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Use the configured shared folder; only when none is set, a test one.
    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="tickerlake-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tickerlake-test-")
