"""One scan, several targets: the rows of separate writes, from one pass."""

import pytest
from pyspark.sql import functions as F

from tablewright.errors import SelfOverwriteError
from tablewright.session import new_work_dir
from tablewright.sinks.routed import routed, write_routed


@pytest.fixture()
def source(spark, workdir):
    spark.range(1000, numPartitions=6).selectExpr(
        "id", "CASE WHEN id % 4 > 0 THEN id % 9 END AS catid", "concat('r', id) AS name").write.parquet(f"{workdir}/src")
    return spark.read.parquet(f"{workdir}/src")


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_filtered_and_unfiltered_targets(spark, workdir, source):
    targets = {f"{workdir}/all": None, f"{workdir}/small": F.col("catid") < 7, f"{workdir}/none": F.col("id") < 0,
               f"{workdir}/rest": ~(F.col("catid") < 7)}
    for _ in range(2):  # absent targets, then an overwrite
        counts = write_routed(source, targets)
        for path, condition in targets.items():
            got, want = spark.read.parquet(path), source if condition is None else source.where(condition)
            assert got.schema == source.schema and same(got, want) and counts[path] == want.count()
    import os
    left = os.listdir(workdir.removeprefix("file:"))
    assert sorted(left) == ["all", "none", "rest", "small", "src"]


def test_one_scan(source):
    plan = routed(source, [None, F.col("catid") < 7])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_a_failed_pass_changes_nothing(spark, workdir, source):
    targets = {f"{workdir}/a": None, f"{workdir}/b": F.col("id") > 5}
    write_routed(source, targets)
    bad = source.withColumn("name", F.when(F.col("id") == 999, F.raise_error(F.lit("bad value"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="bad value"):
        write_routed(bad, targets)
    assert same(spark.read.parquet(f"{workdir}/a"), source)
    assert same(spark.read.parquet(f"{workdir}/b"), source.where("id > 5"))


def test_refusals(spark, workdir, source):
    with pytest.raises(SelfOverwriteError):
        write_routed(source, {f"{workdir}/src": None})
    with pytest.raises(SelfOverwriteError):
        write_routed(source, {f"{workdir}/x": None, f"{workdir}/x/y": None})
    with pytest.raises(ValueError, match="is taken"):
        write_routed(source.withColumn("__route", F.lit(1)), {new_work_dir(spark, "x"): None})
    assert write_routed(source, {}) == {}
