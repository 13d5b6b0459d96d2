import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seqframe.session import ensure_checkpoint_dir, get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="seqframe-tests", shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def col_values(df, col):
    return [r[0] for r in df.select(col).collect()]
