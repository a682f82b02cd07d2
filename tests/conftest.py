import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    s = build_session(
        "tessera-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]
