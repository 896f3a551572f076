import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from reelsieve.session import local_session

    return local_session(cpus="*", partitions=8, memory="6g", app="tests")


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def middle():
    return f"{DATA}/sf0.01"
