"""Shared folders, kept intermediates and actions run together."""

from types import SimpleNamespace

import pytest

from quotewright.session import keep, shared_dir, together


def _session(master, named=None):
    context = SimpleNamespace(
        master=master, applicationId="app", getConf=lambda: SimpleNamespace(get=lambda key: named)
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))


def test_the_named_folder_is_used():
    assert shared_dir(_session("yarn", "hdfs:///checkpoints/")) == "hdfs:///checkpoints"
    assert shared_dir(_session("local[2]", "/named")) == "/named"


def test_a_cluster_without_a_named_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_session("spark://host:7077"))


def test_a_local_session_gets_one_folder_of_its_own():
    assert shared_dir(_session("local[2]")) == shared_dir(_session("local[2]"))


def test_keep_cuts_the_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 as twice").where("id > 10")
    kept = keep(df)
    assert kept.inputFiles() and all(shared_dir(spark) in f for f in kept.inputFiles())
    assert sorted(kept.collect()) == sorted(df.collect())


def test_together_keeps_order_and_raises():
    assert together([lambda i=i: i * i for i in range(20)]) == [i * i for i in range(20)]
    with pytest.raises(ZeroDivisionError):
        together([lambda: 1, lambda: 1 // 0])
