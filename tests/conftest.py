import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tieweave.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 2)
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture(scope="session")
def small(spark):
    from tieweave.plans.workspace import workspace

    return workspace(spark, SMALL)
