import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from squall.session import checkpoint_root, local_session

    s = local_session("*", 8, "squall-tests")
    checkpoint_root(s)  # uses spark.checkpoint.dir; sets a local one only if unset
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from squall.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)

    return make
