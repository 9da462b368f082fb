import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quarry.session import build_session
    ck = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[4]", 4, extra={"spark.checkpoint.dir": ck})
    s.sparkContext.setCheckpointDir(ck)
    yield s
    s.stop()


def rows(df, order=None):
    cols = df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t))
