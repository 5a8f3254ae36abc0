import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidemark.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=8, shuffle_partitions=4, app="tidemark-tests")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def sf_check():
    return str(TESTDATA / "sf0.01")
