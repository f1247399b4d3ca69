"""The scratch folder: shared, private, released."""

import os

import pytest

from tallyguard import session


def test_private_folder_in_one_process(spark):
    kept = session.stored(spark.range(3), "numbers")
    assert kept.count() == 3 and os.path.isdir(session.scratch_root(spark))


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        master, applicationId = "local-cluster[3,2,1000]", "app-1"

        class _jsc:
            @staticmethod
            def sc():
                return Cluster

        class given:
            @staticmethod
            def isDefined():
                return False

        @staticmethod
        def getCheckpointDir():
            return Cluster.given

    class Session:
        sparkContext = Cluster()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_release(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda s: str(tmp_path / "scratch"))
    session.stored(spark.range(3), "numbers")
    assert os.listdir(tmp_path / "scratch")
    session.release_scratch(spark)
    assert not os.path.exists(tmp_path / "scratch")
