import os
from types import SimpleNamespace

import pytest

from orelake.session import scratch_dir


def session(master, shared=None):
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda key, default: shared))


def test_scratch_folders():
    assert os.path.isdir(scratch_dir(session("local[4]"), "x")) and os.path.isdir(scratch_dir(session("local"), "x"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            scratch_dir(session(master), "x")
        a, b = (scratch_dir(session(master, "hdfs://name/ckpt/"), "x") for _ in range(2))
        assert a != b and a.startswith("hdfs://name/ckpt/orelake-x-")
