"""Checkpoint-directory rules of the session helpers."""

from types import SimpleNamespace

import pytest

from concord.session import ensure_checkpoint_dir


class FakeContext:
    def __init__(self, master, conf_dir=None):
        self.master, self._conf, self.dir = master, {"spark.checkpoint.dir": conf_dir} if conf_dir else {}, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d

    def getConf(self):
        return SimpleNamespace(get=lambda k, default=None: self._conf.get(k, default))


def test_cluster_without_a_shared_checkpoint_dir_raises():
    with pytest.raises(RuntimeError, match="shared folder"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=FakeContext("yarn")))


def test_configured_dir_is_used_as_is():
    sc = FakeContext("yarn", "hdfs:///shared/ckpt")
    assert ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc)) == "hdfs:///shared/ckpt"


def test_local_session_gets_a_private_folder():
    sc = FakeContext("local[8]")
    assert ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc)).startswith("/tmp/concord-ckpt-")
