"""Where jobs may write."""

from types import SimpleNamespace

import pytest

from tallywatch.session import shared_folder


def session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default), sparkContext=SimpleNamespace(master=master)
    )


def test_the_named_folder_is_used(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(session("yarn", "hdfs://shared/")) == "hdfs://shared"


def test_a_local_folder_only_on_a_local_master():
    assert "tallywatch-" in shared_folder(session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
