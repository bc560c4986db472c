"""The shared folder of intermediate tables."""

from types import SimpleNamespace

import pytest

from riskengine.session import shared_root


def session_of(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    context.setCheckpointDir = lambda path: None
    return SimpleNamespace(conf=conf, sparkContext=context)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(session_of(master))
    assert shared_root(session_of(master, "hdfs:///shared/")) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_master_may_use_a_temporary_folder(master):
    assert shared_root(session_of(master))
