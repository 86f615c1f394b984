"""Intermediate tables: where they lie and when they go."""

import os
from types import SimpleNamespace

import pytest

from bustrace import session


def folders(path):
    return [d for d in os.listdir(path)] if os.path.isdir(path) else []


def test_tables_go_at_the_end_of_a_block(spark):
    base = f"{session.shared_folder(spark)}/bustrace/{spark.sparkContext.applicationId}"
    with session.scratch():
        stored = session.store(spark.range(5), "numbers")
        assert stored.count() == 5
        assert any(d.startswith("numbers-") for d in folders(base))
    assert not any(d.startswith("numbers-") for d in folders(base))


def cluster(folder, master="spark://host:7077", default="file:///"):
    conf = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "/warehouse"}
    hadoop = SimpleNamespace(hadoopConfiguration=lambda: {"fs.defaultFS": default})
    context = SimpleNamespace(master=master, _jsc=hadoop)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: conf.get(k) or d))


def test_a_cluster_needs_a_shared_folder():
    for folder in (None, "/tmp/own"):
        with pytest.raises(ValueError):
            session.shared_folder(cluster(folder))
    assert session.shared_folder(cluster("file:///mnt/shared")) == "file:///mnt/shared"
    assert session.shared_folder(cluster("/shared", default="hdfs://name")) == "/shared"
    with pytest.raises(ValueError):
        session.shared_folder(cluster(None, "local-cluster[2,1,1024]"))
    assert session.shared_folder(cluster(None, "local[4]")) == "/warehouse/scratch"
    assert session.shared_folder(cluster("/tmp/own", "local[4]")) == "/tmp/own"


def test_executors_of_a_local_cluster_share_the_disk_of_the_driver():
    assert session.shared_folder(cluster("/tmp/checkpoints", "local-cluster[3,4,1024]")) == "/tmp/checkpoints"


def test_a_scheme_may_stand_without_an_authority():
    assert session.shared_folder(cluster("file:/mnt/shared")) == "file:/mnt/shared"


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_named_folder_takes_a_warehouse_it_shares(monkeypatch, master):
    there = cluster(None, master)
    there.sparkContext.applicationId = "app"
    there.conf.get = {"spark.sql.warehouse.dir": "file:/mnt/warehouse"}.get
    monkeypatch.setattr(session, "_is_shared", lambda application, folder: True)
    assert session.shared_folder(there) == "file:/mnt/warehouse/scratch"
    monkeypatch.setattr(session, "_is_shared", lambda application, folder: False)
    with pytest.raises(ValueError):
        session.shared_folder(there)


def test_rows_written_by_tasks_are_read_back(spark, tmp_path):
    assert session._is_shared(spark.sparkContext.applicationId, f"file:{tmp_path}/scratch")
