"""Helpers that decide shuffles and storage locations."""

import pytest

from trafficlens import session as S


class _Ctx:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, k, default=None):
        return self.values.get(k, default)


class _Spark:
    def __init__(self, master, conf):
        self.sparkContext = _Ctx(master)
        self.conf = _Conf(conf)


def test_checkpoint_dir_from_session():
    s = _Spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert S.ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.dir == "hdfs:///shared/ckpt"


def test_no_local_fallback_on_a_cluster():
    with pytest.raises(RuntimeError):
        S.ensure_checkpoint_dir(_Spark("yarn", {}))
    assert S.ensure_checkpoint_dir(_Spark("local[2]", {}))  # tests only
