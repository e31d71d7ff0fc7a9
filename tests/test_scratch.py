"""The folder for derived tables."""

from types import SimpleNamespace

import pytest

from jsonmart.scratch import fresh_dir, scratch_root


def session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_session_names_the_folder():
    s = session("yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert scratch_root(s) == "hdfs:///shared/jsonmart/app-yarn"
    assert fresh_dir(s, "x") != fresh_dir(s, "x")


def test_a_cluster_without_shared_folder_stops():
    with pytest.raises(ValueError):
        scratch_root(session("yarn"))


def test_local_session_may_do_without():
    s = session("local[2]")
    assert scratch_root(s) == scratch_root(s)
