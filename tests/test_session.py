"""Session helpers: partition sizing and the shared checkpoint folder."""

import pytest

from daystream import session


def test_scale_settings():
    big = session.scale_settings(100 * 2 ** 40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "200000"
    small = session.scale_settings(10 ** 6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    mid = session.scale_settings(1 << 40, 1000)
    assert mid["spark.sql.shuffle.partitions"] == str((1 << 40) // (256 << 20))


class _Conf:
    def get(self, key, default=None):
        return default


class _Ctx:
    master = "yarn"

    def getConf(self):
        return _Conf()

    def getCheckpointDir(self):
        return None


class _ClusterSession:
    sparkContext = _Ctx()


def test_cluster_session_needs_shared_checkpoint_dir():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_ClusterSession())


def test_local_session_gets_a_folder(spark):
    root = session.checkpoint_root(spark)
    assert root and session.scratch_path(spark, "x").startswith(root.rstrip("/"))
