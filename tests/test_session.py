"""scratch_root: the shared folder comes from the session; a local folder is
made only for local-mode sessions."""

from types import SimpleNamespace

import pytest

from tierkit.session import scratch_root


class _Conf:
    def __init__(self, value=None):
        self.value = value

    def get(self, key, default=None):
        if self.value is None:
            raise KeyError(key)
        return self.value


def _fake(master, value=None):
    sc = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k, d=None: value),
                         getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    return SimpleNamespace(sparkContext=sc, conf=_Conf(value))


def test_cluster_without_checkpoint_dir_refuses_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_fake("yarn"))


def test_cluster_setting_is_used_as_is():
    assert scratch_root(_fake("spark://master:7077", "hdfs://nn/shared/ckpt/")) == \
        "hdfs://nn/shared/ckpt"


def test_session_setting_is_read(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
