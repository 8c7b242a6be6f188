from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from obsengine.session import build_session, checkpoint_dir

    s = build_session("local[*]", app="obsengine-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(s, str(tmp_path_factory.mktemp("ckpt")))
    else:
        checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` (default all) as a sorted list of tuples."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
