import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from courtline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    """A session in a zone that is not UTC: no result may depend on it."""
    session = build_session("courtline-tests", master="local[4]", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.session.timeZone": "America/New_York",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def records(df):
    """Rows as dicts."""
    return [row.asDict(recursive=True) for row in df.collect()]
