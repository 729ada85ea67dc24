from types import SimpleNamespace

import pytest

from wickflow.session import scratch_path, shared_dir


def session(conf=None, context=None, master="spark://cluster:7077"):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: context),
    )


def test_shared_folder_comes_from_the_session():
    assert shared_dir(session("hdfs:///shared/", "hdfs:///other")) == "hdfs:///shared"
    assert shared_dir(session(None, "hdfs:///other")) == "hdfs:///other"
    assert scratch_path(session("hdfs:///shared"), "x").startswith("hdfs:///shared/x-")


def test_a_cluster_must_name_one():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session())


def test_a_local_session_gets_its_own(spark):
    assert shared_dir(spark) == shared_dir(spark)
