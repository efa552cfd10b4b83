import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from accesslake.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("ACCESSLAKE_LOCAL_SCRATCH", tempfile.mkdtemp(prefix="accesslake-tests-"))
    s = get_spark("tests", cpus="*", shuffle_partitions=8)
    yield s


SF_SMALL = "/root/testdata/sf0.001"
