import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tickloom.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    return local_session(8, 4, **{"spark.checkpoint.dir": shared})


@pytest.fixture(scope="session")
def sf_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no test data")
    return str(path)
