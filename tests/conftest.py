import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from marrow.session import local_session

    session = local_session(os.environ.get("TEST_CPUS", "4"), spark__sql__shuffle__partitions="4", spark__driver__memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
