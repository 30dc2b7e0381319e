import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hustings.session import clean_scratch, local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    clean_scratch(session)
    session.stop()


@pytest.fixture
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables on this machine")
    return SF_DIR
