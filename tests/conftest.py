import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chunkspark.session import make_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = make_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def small(spark):
    """Fourteen rows made by rule, the last of NULLs: i1, row_id, d1, d2, t1, t2. Keys and numbers repeat."""
    rows = [
        (n % 4 + 1, n + 1, (n * 37 % 11) / 2 - 1.75, (n * 29 % 13) / 16, "p" * (n % 5 + 1), "qr" * (n * 3 % 6))
        for n in range(13)
    ]
    return spark.createDataFrame([*rows, (None, 14, *[None] * 4)], "i1 long, row_id long, d1 double, d2 double, t1 string, t2 string")
