from tabflow.session import checkpoint_root, scratch_path


def test_checkpoint_root_reads_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == configured.rstrip("/")
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(configured.rstrip("/"))
    assert scratch_path(spark, "models", "m", unique=False).endswith("/tabflow/models/m")


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master="local[2]"):
        self.dir, self.master = None, master

    def getConf(self):
        return _Conf({})

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = "file:" + d + "/uuid"


class _Session:
    def __init__(self, master="local[2]"):
        self.conf = _Conf({})
        self.sparkContext = _Context(master)


def test_checkpoint_root_fallback_when_unset():
    s = _Session()
    first = checkpoint_root(s)
    assert first.startswith("file:") and "tabflow-ckpt-" in first
    assert checkpoint_root(s) == first  # later calls agree


def test_checkpoint_root_is_required_on_a_cluster():
    import pytest

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(_Session(master))
