"""Scratch folder and temporary settings."""

import pytest

from daybook import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, setting=None, folder=None):
        self.sparkContext, self.setting = Context(master, folder), setting
        self.conf = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.setting or default


def test_the_folder_the_session_names_is_used(spark):
    assert session.scratch_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_folder(Session("spark://x", "hdfs:///scratch/")) == "hdfs:///scratch"
    assert session.scratch_folder(Session("spark://x", None, "hdfs:///set")) == "hdfs:///set"


def test_only_a_local_master_gets_a_folder_of_its_own():
    local = Session("local[8]")
    folder = session.scratch_folder(local)
    assert folder == local.sparkContext.folder == session.scratch_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_folder(Session("yarn"))


def test_setting_is_put_back_after_an_error(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), session.session_setting(spark, key, "dynamic"):
        assert spark.conf.get(key).lower() == "dynamic"
        raise RuntimeError
    assert spark.conf.get(key) == before
