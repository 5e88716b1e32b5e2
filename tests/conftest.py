import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from obsflow.session import get_spark
    s = get_spark("local[*]", app="obsflow-tests", shuffle_partitions=8,
                  extra_conf={"spark.ui.showConsoleProgress": "false", "spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="obsflow-test-ckpt-"))
    yield s


def rec(**kw):
    """A record dict with every field (None unless given)."""
    from obsflow.schemas import RECORD_FIELDS
    d = {f: None for f in RECORD_FIELDS}
    d.update(kw)
    return d
