"""Shared-folder resolution (no machine-local folder on a cluster)."""

import pytest

from obsflow.session import ensure_shared_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):  # pragma: no cover - must not be called
        raise AssertionError("spark.checkpoint.dir cannot be set at run time")


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master)


def test_configured_folder_is_used_as_is():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert ensure_shared_dir(s) == "hdfs://nn/shared/ckpt"


def test_local_mode_falls_back_to_a_temporary_folder_once():
    s = _Session("local[4]")
    first = ensure_shared_dir(s)
    assert first and s.sparkContext.dir == first
    assert ensure_shared_dir(s) == first


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir is not set"):
        ensure_shared_dir(_Session("yarn"))


def test_no_driver_folder_on_a_cluster(tmp_path):
    from obsflow.session import new_work_path

    shared = str(tmp_path / "shared")
    assert new_work_path(_Session("spark://cluster:7077", {"spark.checkpoint.dir": shared}), "x").startswith(f"{shared}/obsflow/x-")
    assert not (tmp_path / "shared").exists()
    new_work_path(_Session("local[2]", {"spark.checkpoint.dir": f"file://{shared}"}), "x")
    assert (tmp_path / "shared" / "obsflow").exists()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir is not set"):
        ensure_shared_dir(_Session("local-cluster[2,1,1024]"))
