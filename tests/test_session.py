"""Where scratch may go."""

from types import SimpleNamespace

import pytest

from fareflow.session import scratch_path, shared_dir


def _session(master, named):
    conf = SimpleNamespace(get=lambda key, default=None: named if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_the_named_folder_is_used():
    assert shared_dir(_session("spark://host:7077", "hdfs://nn/shared/")) == "hdfs://nn/shared"
    one, two = (scratch_path(_session("yarn", "s3a://b/x"), "log") for _ in range(2))
    assert one.startswith("s3a://b/x/log-") and one != two


def test_a_cluster_needs_a_named_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_session("yarn", None))


def test_a_local_session_may_use_its_machine():
    assert "fareflow-" in shared_dir(_session("local[2]", None))


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.ui.enabled") == "false"
