import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakeops.session import build_session, scratch_path  # noqa: E402
from lakeops.sources.snapshot import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "lakeops-tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    return Lake(spark, scratch_path(spark, "test-lake"))


@pytest.fixture
def scratch(spark):
    return lambda label: scratch_path(spark, label)
