"""Checkpoint folder: read from the session, in the warehouse where none is set; options from outside are kept."""

import pytest

from rulegrid.session import SCALE_CONF, checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, configured=None, current=None):
        self.master = master
        self._conf = _Conf({"spark.checkpoint.dir": configured} if configured else {})
        self._current = current
        self.set_calls = []

    def getCheckpointDir(self):
        return self._current

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self.set_calls.append(path)
        self._current = path


class _Session:
    def __init__(self, context):
        self.sparkContext = context


def test_existing_dir_is_kept():
    ctx = _Context("spark://cluster:7077", current="hdfs://nn/ckpt/abc")
    assert checkpoint_dir(_Session(ctx)) == "hdfs://nn/ckpt/abc"
    assert ctx.set_calls == []


def test_configured_dir_is_used():
    ctx = _Context("spark://cluster:7077", configured="s3a://bucket/ckpt")
    assert checkpoint_dir(_Session(ctx)) == "s3a://bucket/ckpt"
    assert ctx.set_calls == ["s3a://bucket/ckpt"]


def test_session_without_dir_uses_the_warehouse():
    ctx = _Context("yarn")
    session = _Session(ctx)
    session.conf = _Conf({"spark.sql.warehouse.dir": "hdfs://nn/warehouse/"})
    assert checkpoint_dir(session) == "hdfs://nn/warehouse/_checkpoints"


def test_building_a_session_takes_no_checkpoint_folder(monkeypatch):
    import rulegrid.session as module

    monkeypatch.setattr(module, "checkpoint_dir", lambda spark: pytest.fail("no checkpoint is taken here"))
    module.build_session("local[8]")


def test_jvm_options_are_added_to_given_ones(tmp_path, monkeypatch):
    import rulegrid.session as module

    (tmp_path / "spark-defaults.conf").write_text("spark.executor.extraJavaOptions -Dx=1 -Dy=2\n# no\n")
    monkeypatch.setenv("SPARK_CONF_DIR", str(tmp_path))
    from pyspark import SparkContext

    monkeypatch.setattr(SparkContext, "_jvm", None)
    assert module._default_conf()["spark.executor.extraJavaOptions"] == "-Dx=1 -Dy=2"


def test_real_session_has_shared_dir(spark):
    assert checkpoint_dir(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == SCALE_CONF["spark.sql.autoBroadcastJoinThreshold"]
