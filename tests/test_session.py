"""Where shared files go."""

from __future__ import annotations

import pytest

from holdfast import session


class FakeConf:
    def __init__(self, value):
        self.value = value

    def get(self, name, default=None):
        return self.value if name == "spark.checkpoint.dir" else default


class FakeSpark:
    def __init__(self, folder, master):
        self.conf = FakeConf(folder)
        self.sparkContext = type("Context", (), {"master": master})()


def test_named_folder_is_used():
    assert session.shared_root(FakeSpark("hdfs://shared/ck/", "spark://m")) == "hdfs://shared/ck"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError):
        session.shared_root(FakeSpark(None, "spark://m"))


def test_paths_are_never_reused(spark):
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_scratch_tables_are_removed(spark):
    outside = session.staged(spark.range(3), "outside")
    with session.scratch(spark):
        inside = session.fresh_path(spark, "x")
        with session.scratch(spark):
            held = session.staged(spark.range(5), "inner")
            deeper = held.inputFiles()[0]
            assert held.count() == 5
        session.staged(spark.range(2), "x").write.parquet(inside)
        assert spark.read.parquet(inside).count() == 2
    for gone in (inside, deeper):
        with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
            spark.read.parquet(gone)
    assert outside.count() == 3 and "scratch" not in session.fresh_path(spark, "y")


def test_a_local_session_stages_in_its_warehouse(spark):
    context = type("Context", (), {"master": "local[2]", "kept": None, "getCheckpointDir": lambda self: self.kept,
                                   "setCheckpointDir": lambda self, path: setattr(self, "kept", path)})()
    bare = type("Spark", (), {"sparkContext": context, "conf": type("Conf", (), {
        "get": lambda self, name, default=None: "/w/house" if name == "spark.sql.warehouse.dir" else default})()})()
    assert session.shared_root(bare) == "/w/house/checkpoints"
