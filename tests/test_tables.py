import decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import StructType

from tablewright import catalog
from tablewright.errors import SchemaMismatchError, SelfOverwriteError
from tablewright.plans import jobs
from tablewright.schemas import WIDE_DOCUMENT_COLUMNS, wide_document_schema
from tablewright.session import unique_name
from tablewright.sinks.guards import positional_diff
from tablewright.sinks.tables import insert_overwrite

COLS = [("id", "decimal(38,12)"), ("name", "string"), ("amount", "decimal(17,2)")]


def _table(spark, workdir, rows, cols=COLS, label="t"):
    name = unique_name(label)
    catalog.create_table(spark, name, cols, location=f"{workdir}/{name}")
    if rows:
        spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in cols)).write.insertInto(name)
    return name


def test_positional_diff_reports_every_problem(spark):
    tgt = StructType.fromDDL("a decimal(17,2), b string, c bigint")
    assert positional_diff(tgt, tgt) == []
    assert positional_diff(StructType.fromDDL("b string, a decimal(17,2), c bigint"), tgt)
    d = positional_diff(StructType.fromDDL("a decimal(20,5), b string"), tgt)
    assert any("arity" in x for x in d) and any("scale 5 rounded to 2" in x for x in d)
    d = positional_diff(StructType.fromDDL("a string, b string, c int"), tgt)
    assert any("text into a typed column" in x for x in d)
    assert not positional_diff(StructType.fromDDL("a int, b int, c int"),
                               StructType.fromDDL("a decimal(38,12), b string, c bigint"))
    assert positional_diff(StructType.fromDDL("a bigint"), StructType.fromDDL("a decimal(17,2)"))


def test_insert_overwrite_refuses_before_deleting(spark, workdir):
    tgt = _table(spark, workdir, [(decimal.Decimal(1), "keep", decimal.Decimal("1.00"))])
    bad = spark.createDataFrame([("x", decimal.Decimal(2), decimal.Decimal("2.00"))],
                                "name string, id decimal(38,12), amount decimal(17,2)")
    with pytest.raises(SchemaMismatchError, match="lands in target"):
        insert_overwrite(bad, tgt)
    with pytest.raises(SchemaMismatchError, match="arity"):
        insert_overwrite(bad.select("id", "name"), tgt)
    assert [r["name"] for r in spark.table(tgt).collect()] == ["keep"]


def test_self_overwrite_refused(spark, workdir):
    tgt = _table(spark, workdir, [(decimal.Decimal(1), "keep", decimal.Decimal("1.00"))])
    with pytest.raises(SelfOverwriteError):
        insert_overwrite(spark.table(tgt), tgt)
    with pytest.raises(SelfOverwriteError):
        jobs.snapshot_copy(spark, tgt, tgt, columns=COLS, location=f"{workdir}/x")
    assert spark.table(tgt).count() == 1


def test_snapshot_copy_replaces_and_keeps_decimals(spark, workdir):
    big = decimal.Decimal("123456789012345678901234.5")
    src = _table(spark, workdir, [(big, "a", decimal.Decimal("1.25")), (None, None, None)], label="src")
    dst = unique_name("dst")
    for _ in range(2):
        out = jobs.snapshot_copy(spark, src, dst, columns=COLS, location=f"{workdir}/{dst}")
        assert out.count() == 2
    assert big in [r["id"] for r in out.collect()]


def test_decimal_overflow_raises(spark, workdir):
    tgt = _table(spark, workdir, [], cols=[("amount", "decimal(17,2)")])
    big = spark.sql("SELECT CAST('123456789012345678901234.5' AS DECIMAL(38,12)) AS amount")
    with pytest.raises(SchemaMismatchError):
        insert_overwrite(big, tgt)
    with pytest.raises(PySparkException):
        big.write.insertInto(tgt, overwrite=True)  # what an unchecked insert does


def test_wide_snapshot_to_sequencefile(spark, workdir):
    assert len(wide_document_schema().fields) == 163
    exprs = []
    for n, t in WIDE_DOCUMENT_COLUMNS:
        st = "timestamp_ntz" if t == "timestamp" else t
        exprs.append(f"CAST(CASE WHEN id % 2 = 0 THEN NULL ELSE id END AS {st}) AS {n}"
                     if t not in ("string", "timestamp")
                     else (f"concat('v\\t', id) AS {n}" if t == "string"
                           else f"timestamp_ntz'2024-01-01 00:00:00.000001' AS {n}"))
    src = unique_name("wide_src")
    spark.range(20).selectExpr(*exprs).write.option("path", f"{workdir}/{src}").saveAsTable(src)
    tgt = jobs.SequenceTable(f"{workdir}/wide_seq", WIDE_DOCUMENT_COLUMNS)
    back = jobs.snapshot_copy(spark, src, tgt)
    assert back.schema == wide_document_schema()
    assert sorted(back.collect()) == sorted(spark.table(src).collect())
    reordered = unique_name("wide_bad")
    spark.table(src).select(*reversed(spark.table(src).columns)).write \
        .option("path", f"{workdir}/{reordered}").saveAsTable(reordered)
    with pytest.raises(SchemaMismatchError):
        jobs.snapshot_copy(spark, reordered, tgt)


def test_filter_copy_between_catalog_tables(spark, workdir):
    src = _table(spark, workdir, [(decimal.Decimal(i), f"n{i}", None) for i in range(10)], label="category")
    dst = unique_name("category_after")
    unfiltered, written = jobs.filter_copy(
        spark, jobs.CatalogTable(src), jobs.CatalogTable(dst, f"{workdir}/{dst}"),
        predicate="id < :limit", view=unique_name("table11"))
    assert written.count() == 7 and unfiltered.count() == 10
    with pytest.raises(SelfOverwriteError):
        jobs.filter_copy(spark, jobs.CatalogTable(src), jobs.CatalogTable(src), predicate="id < :limit")


def test_external_table_scan_and_drop_keeps_data(spark, workdir):
    spark.range(5).write.parquet(f"{workdir}/ext")
    name = unique_name("redshift_table")
    assert jobs.external_table_scan(spark, name, "parquet", {"path": f"{workdir}/ext"}).count() == 5
    catalog.drop_table(spark, name)
    assert spark.read.parquet(f"{workdir}/ext").count() == 5
    catalog.drop_table(spark, name)  # guarded: a second drop is fine


def test_view_rebinding_keeps_old_plans(spark):
    a = spark.range(3)
    catalog.register_view(a, "tw_rebind")
    first = spark.sql("SELECT * FROM tw_rebind")
    catalog.register_view(spark.range(10), "tw_rebind")
    assert first.count() == 3 and spark.table("tw_rebind").count() == 10


def _versions(spark, workdir, name):
    import os
    from conftest import local_path
    return sorted(d for d in os.listdir(local_path(workdir)) if d.startswith(name))


def test_reruns_leave_no_data_behind(spark, workdir):
    src = _table(spark, workdir, [(decimal.Decimal(1), "a", decimal.Decimal("1.00"))], label="src")
    dst = unique_name("dst")
    for _ in range(3):
        jobs.snapshot_copy(spark, src, dst, columns=COLS, location=f"{workdir}/{dst}")
    assert len(_versions(spark, workdir, dst)) == 1
    # a new shape: the table is re-created, the old data removed after the load
    narrow = unique_name("narrow")
    spark.table(src).select("id", "name").write.option("path", f"{workdir}/{narrow}").saveAsTable(narrow)
    out = jobs.snapshot_copy(spark, narrow, dst, columns=COLS[:2], location=f"{workdir}/{dst}")
    assert out.columns == ["id", "name"] and out.count() == 1
    assert len(_versions(spark, workdir, dst)) == 1
