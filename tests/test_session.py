"""Session settings and the shared folder."""

from types import SimpleNamespace

import pytest

from beforehand.session import SETTINGS, shared_dir


def fake(master, root=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: root or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_settings_are_in_force(spark):
    for name, value in SETTINGS.items():
        assert spark.conf.get(name) == value, name


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake("spark://host:7077"), "x")


def test_the_session_names_the_shared_folder():
    assert shared_dir(fake("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")


def test_a_local_session_may_use_its_own_folder():
    a, b = shared_dir(fake("local[2]"), "x"), shared_dir(fake("local[2]"), "x")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
