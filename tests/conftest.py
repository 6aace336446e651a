import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lodestrata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "6g", "tests", shuffle_partitions=4)


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)
