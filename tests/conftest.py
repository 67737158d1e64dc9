import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tokenmill.session import checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="tokenmill-tests")
    checkpoint_dir(s)  # registers a scratch folder only when the session names none
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
