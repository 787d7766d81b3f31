import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidecast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", "tidecast-tests", **{"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def lab(spark, sf):
    from tidecast.queries import Lab

    return Lab(spark, sf)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())
