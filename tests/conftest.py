import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablework.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Tests set their own shared folder; on a cluster spark.checkpoint.dir is given.
    ckpt = tempfile.mkdtemp(prefix="tw-test-ckpt-")
    s = get_session("local[4]", 8, app_name="tablework-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def _key(t):
    return tuple((x is None, x if x is not None else 0) for x in t)


def rows(df, *cols):
    """Rows as sorted tuples (NULLs last within a column)."""
    if cols:
        return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)
    return sorted((tuple(r) for r in df.collect()), key=_key)
