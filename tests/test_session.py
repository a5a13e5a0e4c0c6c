from __future__ import annotations

from types import SimpleNamespace

from feedloom import session


def fake(master, **settings):
    conf = SimpleNamespace(get=lambda name, default=None: settings.get(name, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_folder_is_the_one_the_cluster_names():
    shared = fake("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.work_path(shared, "t").startswith("hdfs:///shared/t-")
    assert session.work_path(shared, "t") != session.work_path(shared, "t")


def test_unset_it_lies_in_the_warehouse_on_every_master():
    for master in ("local[4]", "yarn"):
        assert session.work_folder(fake(master, **{"spark.sql.warehouse.dir": "hdfs:///w/"})) == "hdfs:///w/_work"


def test_settings_are_applied(spark):
    assert {name: spark.conf.get(name) for name in session.RUNTIME_SETTINGS} == session.RUNTIME_SETTINGS
