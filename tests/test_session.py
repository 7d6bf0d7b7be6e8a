"""The shared folder with and without spark.checkpoint.dir."""

import os
from types import SimpleNamespace

import pytest

from quarterdeck import session


def fake(master, folder=None):
    """A session whose settings cannot be changed, as those of a running one."""
    conf = SimpleNamespace(get=lambda key, default=None: folder)
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: conf), conf=conf)


def test_the_setting_wins():
    assert session.shared_dir(fake("spark://host:7077", "hdfs://host/shared")) == "hdfs://host/shared"


def test_local_sessions_keep_one_folder():
    first = session.shared_dir(fake("local[2]"))
    assert os.path.isdir(first) and session.shared_dir(fake("local[2]")) == first


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("spark://host:7077"))
