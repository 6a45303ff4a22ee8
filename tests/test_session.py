"""The shared work folder."""

import pytest

from ledgerlake import session


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getConf(self):
        return {}


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _Context(master), {}


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session(master))


def test_local_runs_take_a_temporary_folder():
    assert session.ensure_checkpoint_dir(_Session("local[2]"))
