from types import SimpleNamespace

import pytest

from chunkspark.session import checkpointed, register_views, shared_dir


class Context:
    """The parts of a Spark context that shared_dir reads."""

    def __init__(self, master, named=None):
        self.master, self.folder = master, None
        self.named = {"spark.checkpoint.dir": named}

    def getConf(self):
        return SimpleNamespace(get=self.named.get)

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=Context("yarn")))


def test_the_named_folder_is_used():
    assert shared_dir(SimpleNamespace(sparkContext=Context("yarn", "hdfs:/shared"))) == "hdfs:/shared"


def test_a_local_session_gets_a_folder_of_its_own():
    assert "chunkspark-" in shared_dir(SimpleNamespace(sparkContext=Context("local[2]")))


def test_a_checkpoint_holds_its_rows(spark):
    frozen = checkpointed(spark.sql("SELECT id, rand() AS r FROM range(100)"))
    assert frozen.exceptAll(frozen).count() == 0 and frozen.count() == 100


def test_views(spark, sf_dir):
    register_views(spark, sf_dir, ["nation", "region"])
    assert spark.table("nation").count() == 25
