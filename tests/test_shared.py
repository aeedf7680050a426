from types import SimpleNamespace

import pytest

from tidemark.shared import (
    child_names,
    delete_path,
    fresh_folder,
    is_complete,
    matching_paths,
    path_exists,
    shared_folder,
)


def session(master, setting=None, directory=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: directory)
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context
    )


def test_the_named_folder_is_used_everywhere():
    assert shared_folder(session("spark://x", "hdfs://n/ck/")) == "hdfs://n/ck"
    assert shared_folder(session("local[2]", "/shared")) == "/shared"
    assert shared_folder(session("yarn", None, "s3a://b/ck")) == "s3a://b/ck"


def test_only_a_local_master_may_use_a_temporary_folder():
    assert shared_folder(session("local[2]")) == shared_folder(session("local[*]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_the_session_setting_is_read(spark):
    folder = fresh_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert not path_exists(spark, folder)


def test_file_calls(spark, tmp_path):
    path = str(tmp_path / "table")
    assert child_names(spark, path) == [] and matching_paths(spark, f"{path}/a=*") == []
    spark.range(3).selectExpr("id", "id % 2 as a").write.partitionBy("a").parquet(path)
    assert is_complete(spark, path)
    assert [name for name in child_names(spark, path) if "=" in name] == ["a=0", "a=1"]
    assert [p.rsplit("/", 1)[1] for p in matching_paths(spark, f"{path}/a=*")] == ["a=0", "a=1"]
    delete_path(spark, f"{path}/a=0")
    delete_path(spark, f"{path}/missing")
    assert not path_exists(spark, f"{path}/a=0")
