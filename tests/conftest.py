import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chatmill.plans.session import local_session  # noqa: E402

FOLDER = os.environ.get("CHATMILL_TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus=4, shuffle_partitions=4, memory="4g")


@pytest.fixture(scope="session")
def folder():
    path = f"{FOLDER}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
