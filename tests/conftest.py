from __future__ import annotations

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from skyledger.session import local_session

    base = tmp_path_factory.mktemp("work")
    session = local_session(8, **{"spark.checkpoint.dir": str(base)})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows(spark):
    """Build a DataFrame from tuples and a schema string."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
