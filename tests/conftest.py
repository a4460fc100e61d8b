import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from offerline.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="offerline-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="offerline-test-")
