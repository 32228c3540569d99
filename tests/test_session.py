from types import SimpleNamespace

import pytest

from genoweave.session import remove_written, scratch_path, shared_dir, written


def session(setting=None, folder=None):
    context = SimpleNamespace(getCheckpointDir=lambda: folder)
    settings = {"spark.checkpoint.dir": setting, "spark.sql.warehouse.dir": "hdfs://warehouse/"}
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default))


def test_the_named_folder_is_used():
    assert shared_dir(session(setting="hdfs://shared/rows")) == "hdfs://shared/rows"
    assert shared_dir(session(folder="file:/x")) == "file:/x"


def test_without_one_the_warehouse_is_used():
    assert shared_dir(session()) == "hdfs://warehouse/intermediates"


def test_written_rows_come_back(spark, frame):
    df = frame("a int, b array<string>", (1, ["x"]), (2, None))
    back = written(df)
    assert back.schema == df.schema and {r.a: r.b for r in back.collect()} == {1: ["x"], 2: None}


def test_what_was_written_can_be_removed(spark, tmp_path):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert remove_written(spark, [path]) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
