from types import SimpleNamespace

import pytest

from beatwise.session import CLUSTER_CONF, ensure_checkpoint_dir, staging_path


def _session(master, folder=None, conf=None):
    """What ``ensure_checkpoint_dir`` sees of a session."""
    return SimpleNamespace(
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: folder),
        conf=SimpleNamespace(get=lambda key, default=None: conf or default))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_session(master))
    assert ensure_checkpoint_dir(_session(master, conf="hdfs:///shared")) == "hdfs:///shared"
    assert ensure_checkpoint_dir(_session(master, folder="hdfs:///set", conf="hdfs:///x")) == "hdfs:///set"


def test_local_session_gets_one_temporary_folder():
    first = ensure_checkpoint_dir(_session("local[4]"))
    assert first == ensure_checkpoint_dir(_session("local[4]"))


def test_checkpoint_dir_is_reused(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first
    assert first == spark.sparkContext.getCheckpointDir()


def test_staging_paths_are_fresh_and_under_checkpoint_dir(spark):
    a, b = staging_path(spark, "x"), staging_path(spark, "x")
    base = ensure_checkpoint_dir(spark).rstrip("/")
    assert a != b and a.startswith(f"{base}/staging/x-") and b.startswith(f"{base}/staging/x-")


def test_cluster_profile_only_broadcasts_measured_sizes():
    assert CLUSTER_CONF["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert "spark.sql.adaptive.autoBroadcastJoinThreshold" in CLUSTER_CONF
