import pytest

from goalpost import session


class _Context:
    def __init__(self, master, shared=None):
        self.master, self.shared, self.set = master, shared, None

    def getConf(self):  # noqa: N802
        return self

    def get(self, key, default=None):
        return self.shared

    def getCheckpointDir(self):  # noqa: N802
        return self.set

    def setCheckpointDir(self, path):  # noqa: N802
        self.set = path


class _Session:
    def __init__(self, *a):
        self.sparkContext = _Context(*a)


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://x"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError):
        session.shared_dir(_Session(master))
    assert session.shared_dir(_Session(master, "hdfs:///shared/")) == "hdfs:///shared"


def test_a_local_session_gets_a_folder(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    for master in ("local", "local[*]", "local[8]"):
        assert session.shared_dir(_Session(master)).startswith(str(tmp_path))
