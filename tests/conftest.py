import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from revcast.session import ensure_checkpoint_dir, get_spark

    s = get_spark("local[4]", app="revcast-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="revcast-test-ckpt-"))
    ensure_checkpoint_dir(s)
    # Hermetic: landed layers of earlier runs are not reused by the tests.
    s.conf.set("revcast.landing.dir", tempfile.mkdtemp(prefix="revcast-test-landing-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Rows as tuples (selected columns, in order), sorted with None first."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, str(v)) for v in t))
