"""Where tables between steps are written, and when they go."""

import os
from types import SimpleNamespace

import pytest

from packetloom.sources.stage import stage_root, stage_scope, write_stage


def session(master, checkpoint=None, conf=None):
    values = {"spark.sql.warehouse.dir": "file:/warehouse", **(conf or {})}
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint, applicationId="app")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, *d: values.get(k, *d)), sparkContext=context)


def test_a_cluster_has_to_name_its_shared_folder():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            stage_root(session(master))
        assert stage_root(session(master, conf={"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared/packetloom"
        assert stage_root(session(master, checkpoint="s3a://bucket/c")) == "s3a://bucket/c/packetloom"


def test_one_process_takes_the_warehouse():
    assert stage_root(session("local[8]")) == stage_root(session("local")) == "file:/warehouse/packetloom"


def test_stages_of_a_scope_are_deleted(spark, tmp_path):
    with stage_scope(spark):
        made = write_stage(spark.range(5), "scoped")
        folder = made.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        made.write.parquet(str(tmp_path / "out"))
        assert os.path.isdir(folder)
    assert not os.path.isdir(folder) and spark.read.parquet(str(tmp_path / "out")).count() == 5
