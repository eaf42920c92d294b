import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import checkpoint_root, local_session

    s = local_session("*", 8, app="tidemark-tests")
    checkpoint_root(s)  # sets a local folder only when the session names none
    yield s
    s.stop()


@pytest.fixture
def path(spark):
    from tidemark.session import scratch_path

    counter = iter(range(1000))
    return lambda name="t": scratch_path(spark, f"test-{name}-{next(counter)}")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
