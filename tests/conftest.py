import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyframe.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    """The formatted physical plan, not cut short."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture
def rows():
    """Rows of a table as a sorted list of tuples."""

    def collect(df):
        return sorted([tuple(r) for r in df.collect()], key=repr)

    return collect
