import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="tidewater-tests-")
    s = build_session("local[4]", app="tidewater-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": shared})
    yield s
    s.stop()


def rows(df, cols=None):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
