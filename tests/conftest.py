import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tillroll.session import DEFAULTS, ensure_checkpoint_dir

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("tillroll-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tillroll-warehouse-"))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    # Results must not depend on the session time zone; run with another
    # zone through TILLROLL_TEST_TZ to check.
    builder = builder.config("spark.sql.session.timeZone", os.environ.get("TILLROLL_TEST_TZ", "UTC"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="tillroll-test-")
