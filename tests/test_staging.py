from __future__ import annotations

import os

from gridtide import staging


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, values, master="local[2]"):
        self.conf = _Conf(values)
        self.sparkContext = type("C", (), {"master": master, "getConf": lambda s: _Conf(values)})()


def test_root_is_the_shared_folder_when_named():
    session = _Session({"spark.checkpoint.dir": "hdfs://lake/tmp/"}, "yarn")
    assert staging.staging_root(session) == "hdfs://lake/tmp"
    assert os.path.isdir(staging.staging_root(_Session({})))


def test_a_cluster_must_name_it():
    try:
        staging.staging_root(_Session({}, "yarn"))
    except RuntimeError as error:
        assert "spark.checkpoint.dir" in str(error)
    else:
        raise AssertionError("no error")


def test_stage_and_spread(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    first, second = staging.stage(df, "t"), staging.stage(df, "t")
    assert first.columns == df.columns and sorted(map(tuple, first.collect())) == sorted(map(tuple, df.collect()))
    assert first.inputFiles() != second.inputFiles()
    assert staging.spread(first.coalesce(1)).rdd.getNumPartitions() >= 8
