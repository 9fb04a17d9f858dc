"""The shared folder: taken from the session, never invented on a cluster."""

import pytest

from tessera import session


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path

    def getConf(self):
        return {}


class _Session:
    def __init__(self, master, conf=()):
        self.sparkContext, self.conf = _Context(master), dict(conf)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[3,2,1024]"])
def test_a_cluster_without_the_setting_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session(master))


def test_the_setting_is_used():
    assert session.ensure_checkpoint_dir(_Session("yarn", {"spark.checkpoint.dir": "hdfs://x/y"})) == "hdfs://x/y"


def test_local_without_the_setting_gets_a_folder():
    assert session.ensure_checkpoint_dir(_Session("local[2]"))
