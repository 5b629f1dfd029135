from __future__ import annotations

import pytest

from chronoloom.session import scratch_path, scratch_root, use_utc


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, folder=None):
        self.sparkContext = Context(master)
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_the_shared_folder_is_used():
    assert scratch_root(Session("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        scratch_root(Session("yarn"))


def test_a_local_session_keeps_its_own_folder():
    session = Session("local[2]")
    assert scratch_root(session) == scratch_root(session)


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    assert use_utc(spark).conf.get("spark.sql.session.timeZone") == "UTC"
