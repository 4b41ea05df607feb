import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("shared")
    session = build_session(
        "millrace-tests", master="local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.checkpoint.dir": str(scratch), "spark.driver.memory": "4g",
           "spark.sql.warehouse.dir": str(scratch / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=str)
