"""Refused and failed jobs leave old tables, folders and rows as they were."""

import os

import pytest
from conftest import local_path, write_text
from tablewright import catalog
from tablewright.errors import CapabilityError, SchemaMismatchError, SelfOverwriteError, TableJobError
from tablewright.functions.charset import outside_charset
from tablewright.plans import jobs
from tablewright.session import unique_name
from tablewright.sinks import replace as R
from tablewright.sinks.csv import write_csv
from tablewright.sinks.guards import plan_roots
from tablewright.sinks.tables import insert_overwrite, table_identity
from tablewright.sources.csv import read_csv_header, read_csv_typed
from pyspark.sql import functions as F

NEW = [("a", "bigint"), ("b", "string")]


@pytest.fixture()
def old(spark, workdir):
    """An archive of another shape with five rows."""
    name = unique_name("arch")
    spark.range(5).select(F.col("id").alias("x")).write.option("path", f"{workdir}/{name}").saveAsTable(name)
    return name


def _source(spark, workdir, *columns):
    name = unique_name("src")
    spark.range(3).selectExpr(*columns).write.option("path", f"{workdir}/{name}").saveAsTable(name)
    return name


def test_wrong_columns_leave_the_target(spark, workdir, old):
    src = _source(spark, workdir, "id AS a", "id AS wrong")
    with pytest.raises(SchemaMismatchError):
        jobs.snapshot_copy(spark, src, old, columns=NEW)
    assert spark.table(old).columns == ["x"] and spark.table(old).count() == 5


def test_the_source_spelled_two_ways_is_refused(spark, workdir):
    src = _source(spark, workdir, "id AS a", "string(id) AS b")
    for target in (f"default.{src}", f"`default`.`{src}`", f"spark_catalog.default.{src}", src.upper()):
        with pytest.raises(SelfOverwriteError):
            jobs.snapshot_copy(spark, src, target, columns=[("a", "bigint"), ("b", "string")])
        assert spark.table(src).count() == 3
    assert table_identity(spark, src) == table_identity(spark, f"default.{src}")


def test_failing_rows_leave_the_target(spark, workdir, old):
    src = unique_name("v")
    spark.range(3).select(F.col("id").alias("a"), F.when(F.col("id") < 2, "ok").otherwise(
        F.raise_error(F.lit("bad row")).cast("string")).alias("b")).createOrReplaceTempView(src)
    with pytest.raises(Exception, match="bad row"):
        jobs.snapshot_copy(spark, src, old, columns=NEW)
    assert spark.table(old).columns == ["x"] and spark.table(old).count() == 5


def test_missing_data_file_leaves_the_table(spark, workdir, old):
    with pytest.raises(Exception):
        jobs.limits_load(spark, old, f"{workdir}/nowhere", f"{workdir}/limits")
    assert spark.table(old).columns == ["x"] and spark.table(old).count() == 5


def test_another_shape_is_replaced_when_all_is_well(spark, workdir, old):
    src = _source(spark, workdir, "id AS a", "string(id) AS b")
    assert jobs.snapshot_copy(spark, src, old, columns=NEW).count() == 3
    assert spark.table(old).columns == ["a", "b"]
    assert jobs.snapshot_copy(spark, src, old, columns=NEW).count() == 3  # same shape: overwritten


def test_new_table_without_location(spark, workdir):
    src = _source(spark, workdir, "id AS a", "string(id) AS b")
    assert jobs.snapshot_copy(spark, src, unique_name("fresh"), columns=NEW).count() == 3


def test_empty_and_null_limits_stay_apart(spark, workdir):
    data = write_text(f"{workdir}/limits.data", "\t1\t1.5\n\\N\t2\t2.5\nabc\t3\t3.5\n", "windows-1251")
    rows = jobs.limits_load(spark, unique_name("limits"), data, f"{workdir}/limits").orderBy("up").collect()
    assert [r.crit for r in rows] == ["", None, "abc"]


def test_load_uses_the_tables_layout_and_cleans_up(spark, workdir, tmp_path):
    name = unique_name("t")
    spark.sql(f"CREATE TABLE {name} (a string, b int) USING csv OPTIONS (sep '|', nullValue '-', quote '\u0000') "
              f"LOCATION '{workdir}/{name}'")
    (tmp_path / "f.txt").write_text("x|1\n-|2\n")
    shared = os.path.dirname(local_path(workdir))
    before = {n for n in os.listdir(shared) if n.startswith("load-data-local")}
    catalog.load_file_overwrite(spark, name, str(tmp_path / "f.txt"), local=True)
    assert [tuple(r) for r in spark.table(name).orderBy("b").collect()] == [("x", 1), (None, 2)]
    assert {n for n in os.listdir(shared) if n.startswith("load-data-local")} == before


@pytest.mark.parametrize("layout", ["CLUSTERED BY (a) INTO 4 BUCKETS", "PARTITIONED BY (a)"])
def test_bucketed_and_partitioned_targets_stay_readable(spark, workdir, layout):
    name = unique_name("t")
    spark.sql(f"CREATE TABLE {name} (b string, a int) USING parquet {layout} LOCATION '{workdir}/{name}'")
    for n in (40, 25):
        insert_overwrite(spark.range(n).selectExpr("string(id) AS b", "int(id % 5) AS a"), name)
        assert spark.table(name).groupBy("a").count().agg(F.sum("count")).first()[0] == n
        assert spark.table(name).where("a = 3").count() == n // 5


def test_absent_target_is_written_in_place(spark, workdir, monkeypatch):
    seen = []
    target = f"{workdir}/new"
    R.replace_path(spark, target, lambda p: (seen.append(p), spark.range(2).write.parquet(p)))
    assert [local_path(p).rstrip("/") for p in seen] == [local_path(target)]
    R.replace_path(spark, target, lambda p: (seen.append(p), spark.range(3).write.parquet(p)))
    assert seen[1] != seen[0] and spark.read.parquet(target).count() == 3
    assert sorted(os.listdir(local_path(workdir))) == ["new"]


def test_object_stores_are_not_renamed(spark, workdir, monkeypatch):
    R.replace_path(spark, f"{workdir}/x", lambda p: spark.range(2).write.parquet(p))
    monkeypatch.setattr(R, "OBJECT_STORES", {"file"})
    with pytest.raises(CapabilityError, match="object store"):
        R.replace_path(spark, f"{workdir}/x", lambda p: spark.range(3).write.parquet(p))
    assert spark.read.parquet(f"{workdir}/x").count() == 2


def test_data_left_aside_by_a_lost_driver_comes_back(spark, workdir):
    spark.range(4).write.parquet(f"{workdir}/t")
    os.rename(f"{local_path(workdir)}/t", f"{local_path(workdir)}/.t.old-0123456789ab")
    with pytest.raises(ValueError):
        R.replace_path(spark, f"{workdir}/t", lambda p: (_ for _ in ()).throw(ValueError()))
    assert spark.read.parquet(f"{workdir}/t").count() == 4


def test_roots_not_files_are_compared(spark, workdir):
    spark.range(50).repartition(20).write.parquet(f"{workdir}/in")
    df = spark.read.parquet(f"{workdir}/in").where("id > 3").join(spark.range(9), "id")
    assert [local_path(r).rstrip("/") for r in plan_roots(df)] == [f"{local_path(workdir)}/in"]
    with pytest.raises(SelfOverwriteError):
        write_csv(df, f"{workdir}/in")
    inner = spark.range(3).where(F.col("id").isin(1)).alias("o")
    spark.read.parquet(f"{workdir}/in").createOrReplaceTempView("roots_in")
    assert plan_roots(spark.sql("SELECT * FROM range(3) WHERE id IN (SELECT id FROM roots_in)"))
    assert plan_roots(inner) == []


def test_files_with_other_headers_fail(spark, workdir):
    write_text(f"{workdir}/in/a.csv", "Code,Name\nCAE,one\n")
    write_text(f"{workdir}/in/b.csv", "Name,Code\ntwo,CAE\n")
    with pytest.raises(TableJobError, match="header"):
        jobs.filter_csv_copy(spark, f"{workdir}/in", f"{workdir}/out")
    assert not os.path.exists(f"{local_path(workdir)}/out")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv_header(spark, f"{workdir}/in").select("Name").collect()


def test_doubled_quotes_without_session_settings(spark, workdir):
    write_text(f"{workdir}/q.csv", 'a,b,c\n"a""b",",",y\n"x""",",",z\n')
    key = "spark.sql.csv.parser.columnPruning.enabled"
    assert spark.conf.get(key) == "true"
    want = [(",", "y"), (",", "z")]
    assert [tuple(r) for r in read_csv_header(spark, f"{workdir}/q.csv").select("b", "c").collect()] == want
    name = unique_name("ext")
    jobs.external_table_scan(spark, name, "csv", {"path": f"{workdir}/q.csv", "header": "true", "escape": '"'})
    assert [tuple(r) for r in spark.table(name).select("b", "c").collect()] == want
    assert spark.conf.get(key) == "true"


def test_empty_strings_in_csv(spark, workdir):
    df = spark.createDataFrame([("", 1), (None, 2), (" ", 3), ("x", 4)], "a string, b int")
    write_csv(df, f"{workdir}/marked", null_value="\\N")
    back = read_csv_typed(spark, f"{workdir}/marked", df.schema, null_value="\\N", line_sep="\n")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="read back as null"):
        write_csv(df, f"{workdir}/strict", on_empty="error")
    with pytest.raises(Exception, match="read back as null"):
        write_csv(spark.createDataFrame([("\\N",)], "a string"), f"{workdir}/marker", null_value="\\N")
    write_csv(df, f"{workdir}/plain")
    plain = read_csv_typed(spark, f"{workdir}/plain", df.schema, line_sep="\n").orderBy("b").collect()
    assert [r.a for r in plain] == [None, None, " ", "x"]


@pytest.mark.parametrize("charset", ["gbk", "shift_jis", "big5", "euc-kr"])
def test_multi_byte_charsets_are_refused_by_name(spark, charset):
    with pytest.raises(CapabilityError, match="multi-byte"):
        outside_charset(F.lit("x"), charset)
