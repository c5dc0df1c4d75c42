import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from claimgauge.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def checkpoint_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(checkpoint_dir):
    session = local_session(4, shuffle_partitions=4, spark__checkpoint__dir=checkpoint_dir)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
