"""The shared checkpoint folder: read from the session, never made up on a cluster."""

import pytest

from annotask.session import checkpoint_root, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, checkpoint_dir=None):
        self.master = master
        self._dir = checkpoint_dir

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path


class _Session:
    def __init__(self, conf, master, checkpoint_dir=None):
        self.conf = _Conf(conf)
        self.sparkContext = _Context(master, checkpoint_dir)


def test_configured_folder_is_used():
    s = _Session({"spark.checkpoint.dir": "hdfs:///shared/ckpt/"}, "yarn")
    assert checkpoint_root(s) == "hdfs:///shared/ckpt"
    assert scratch_path(s, "rank").startswith("hdfs:///shared/ckpt/annotask/rank-")


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_root(_Session({}, "spark://master:7077"))


def test_local_without_folder_gets_one():
    s = _Session({}, "local[2]")
    root = checkpoint_root(s)
    assert root and s.conf.get("spark.checkpoint.dir") == root
