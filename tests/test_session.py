"""Session helpers: shared checkpoint folder policy."""

import pytest

from dossier.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, conf=None, ckpt=None):
        self.master = master
        self._conf = _Conf(conf or {})
        self._ckpt = ckpt

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Session:
    def __init__(self, master, sql_conf=None, ctx_conf=None, ckpt=None):
        self.conf = _Conf(sql_conf or {})
        self.sparkContext = _Context(master, ctx_conf, ckpt)


def test_cluster_requires_shared_checkpoint_folder():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn"))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("local-cluster[2,1,1024]"))
    assert ensure_checkpoint_dir(_Session("yarn", sql_conf={"spark.checkpoint.dir": "hdfs:///ck"})) == "hdfs:///ck"
    assert ensure_checkpoint_dir(_Session("k8s://x", ctx_conf={"spark.checkpoint.dir": "s3a://b/ck"})) == "s3a://b/ck"
    assert ensure_checkpoint_dir(_Session("yarn", ckpt="hdfs:///set/by/context")) == "hdfs:///set/by/context"
    local = _Session("local[2]")
    d = ensure_checkpoint_dir(local)
    assert d and local.conf.get("spark.checkpoint.dir") == d
