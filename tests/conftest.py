import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from snapdiff.session import build_session  # noqa: E402

TESTDATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark__ui__enabled": "false",
        "spark__ui__showConsoleProgress": "false",
        "spark__sql__shuffle__partitions": "8",
        "spark__sql__debug__maxToStringFields": "1000",
        "spark__driver__memory": "8g",
        "spark__checkpoint__dir": tempfile.mkdtemp(prefix="snapdiff-tests-"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def sf():
    return str(TESTDATA / "sf0.01")


@pytest.fixture
def records(spark):
    """A record frame from literal lines."""
    def make(*lines):
        return spark.createDataFrame([(line,) for line in lines], "record string")
    return make


@pytest.fixture
def values(spark):
    """Apply a column function to literal texts and list the results in order."""
    from pyspark.sql import functions as F

    def run(fn, *texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        return [r.v for r in df.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]
    return run
