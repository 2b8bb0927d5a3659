import tempfile
from types import SimpleNamespace

import pytest

from ordertally.plans.workspace import new_workspace


def session(**conf):
    values = {name.replace("__", "."): value for name, value in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=values.get))


def test_workspaces_are_new_folders_below_the_shared_one():
    spark = session(spark__checkpoint__dir="hdfs:///shared/", spark__master="yarn")
    first, second = new_workspace(spark), new_workspace(spark)
    assert first != second
    assert first.startswith("hdfs:///shared/ordertally-")


def test_local_mode_may_use_a_temporary_folder():
    assert new_workspace(session(spark__master="local[2]")).startswith(tempfile.gettempdir())


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_workspace(session(spark__master="yarn"))


def test_real_session(spark):
    assert new_workspace(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
