import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from beatwise.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", app_name="beatwise-tests", shuffle_partitions=4,
                          **{"spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="beatwise-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="beatwise-test-")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
