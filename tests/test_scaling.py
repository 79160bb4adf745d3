"""Storage and work of the wide and profiled queries, on rows of their own."""

import datetime
import os

import pyarrow.parquet as pq
import pytest

from pyspark.sql import functions as F

from tablewright import queries
from tablewright.functions.text import csv_options, decode_records
from tablewright.operators.profile import BIT, DATE, DECIMAL, INTEGER, NUMBER, TIMESTAMP, fits, profile
from tablewright.plans import jobs
from tablewright.session import unique_name
from tests.conftest import local_path


def files(path, end):
    return [os.path.join(d, f) for d, _, fs in os.walk(local_path(path)) for f in fs if f.endswith(end)]


@pytest.fixture()
def tables(spark, workdir):
    day = datetime.datetime(1995, 3, 1)
    spark.createDataFrame(
        [(k, k % 7 - 3, "OFP"[k % 3], k * 1.25, day, "1-URGENT") for k in [*range(1, 400), 5, 5]],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string").write.parquet(f"{workdir}/orders.parquet")
    spark.createDataFrame(
        [(k, k % 9, k % 5, k % 4, float(k % 50), k * 1.5, 0.05, 0.02, "ANR"[k % 3], "FO"[k % 2], day) for k in range(2000)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ).write.parquet(f"{workdir}/lineitem.parquet")
    return workdir


def test_wide_copies_are_stored_without_dictionaries(spark, tables):
    got = queries.wide_table_copy(spark, tables)
    assert got.count() == 401 and len(got.columns) == 163
    stored = [p.removeprefix("file://") for p in got.inputFiles()]
    assert stored
    for path in stored:
        group = pq.ParquetFile(path).metadata.row_group(0)
        for i in range(group.num_columns):
            assert group.column(i).compression == "ZSTD" and not group.column(i).has_dictionary_page
    want = spark.read.parquet(f"{tables}/orders.parquet").selectExpr(*queries.wide_document_exprs("spark"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_wide_text_is_staged_compressed(spark, tables):
    src = queries.csv_wide_positional_project.prepare(spark, tables)
    stored = files(src.removeprefix("file:"), ".gz")
    assert stored and not files(src.removeprefix("file:"), ".csv")
    # columns 20, 31 and 61 of the text are columns 9, 9 and 6 of the table
    want = spark.read.parquet(f"{tables}/lineitem.parquet").selectExpr(
        "concat('20|', l_linestatus) AS type1", "concat('31|', l_linestatus) AS region", "concat('61|', l_discount) AS type2")
    got = queries.csv_wide_positional_project.run(spark, tables, src)
    assert sorted(got.collect()) == sorted(want.collect())


def test_a_value_meets_three_patterns_at_most(spark):
    folded = profile(spark.createDataFrame([("1",)], "a string"))
    assert 1 <= folded._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") <= 3


def test_fits_as_each_type_tried_alone(spark):
    values = ["12", "-0", "12\n", "1.5\r\n", "1e400", "-1E5", "2147483647", "2147483648", "-2147483648", "-9223372036854775809",
              "true\n", "TRUE", "fals", "2024-02-29\n", "2024-02-30", "0000-01-01", "2024-02-29 10:00:00.5\r\n", "2024-02-29T25:00:00",
              "1" * 400, "e", "E5", "1.e5", "\u0661", "", " ", "NaN", "Infinity", None]
    v = F.col("v")
    date = v.rlike(DATE) & v.try_cast("date").isNotNull()
    alone = {"boolean": F.lower(v).isin("true", "false"), "int": v.rlike(INTEGER) & v.try_cast("int").isNotNull(),
             "bigint": v.rlike(INTEGER) & v.try_cast("bigint").isNotNull(), "decimal": v.rlike(DECIMAL),
             "double": v.rlike(NUMBER) & v.try_cast("double").isNotNull(), "date": date,
             "timestamp": date | (v.rlike(TIMESTAMP) & v.try_cast("timestamp_ntz").isNotNull())}
    want = sum((F.when(test, F.lit(BIT[t])).otherwise(0) for t, test in alone.items()), F.lit(0))
    rows = spark.createDataFrame([(x,) for x in values], "v string").select("v", fits(v).alias("got"), want.alias("want")).collect()
    assert [(r.v, r.got) for r in rows] == [(r.v, r.want) for r in rows]


def test_decimals_and_timestamps_of_a_record_are_cast_as_the_csv_parser_reads_them(spark):
    decimals = ["1", "-1.25", "+7", "0E-12", "1E+3", "1E-30", "1,234.5", ",", "1, ", ", 1", "1 ,", ",1,", " 1", "1 ", "\n1", "1\n", "1 2", "", "abc", "\\N", "\\\\N", "-", ".5",
                "5.", "99999999999999999999999999", "999999999999999999999999999", "0.0000000000005", "1e", "0x1", "NaN", "1E+40", "\u0661", "\u00a01"]
    day = "2024-02-29 10:11:12.123456"
    stamps = [day, "0001-01-01 00:00:00.000000", "1582-10-10 12:00:00.000001", "9999-12-31 23:59:59.999999", "+10000-01-01 00:00:00.000000",
              "+294247-01-10 04:00:54.775807", "-0001-06-01 00:00:00.000000", "2023-02-29 00:00:00.000000", "2024-02-29", "2024-02-29 10:11:12",
              "2024-02-29 10:11:12.12345", "2024-02-29 10:11:12.1234567", "2024-02-29T10:11:12.123456", day + "Z", day + "+05:00", " " + day,
              day + " ", day + "\n", "2024-2-9 10:11:12.123456", "2024-02-29 24:00:00.000000", "+2024-02-29 10:11:12.123456", "2024-02-29 10:11:60.000000",
              "2024-02-29 10:11:12.12345Z", "2024-02-29 10:11:12.", "2024-02-29 10:11:12.1", "", "\\N", "now", "epoch"]
    pairs = [(d, day) for d in decimals] + [("1", t) for t in stamps]
    quoted = spark.createDataFrame([(i, '"%s"\t"%s"' % p if p[0] != "\\N" and p[1] != "\\N" else "%s\t%s" % p) for i, p in enumerate(pairs)],
                                   "i int, record string")
    schema = spark.createDataFrame([], "d decimal(38,12), t timestamp_ntz").schema
    opts = {k: v for k, v in csv_options("\t", "\\N").items() if k != "header"}
    want = quoted.select("record", F.from_csv("record", "d decimal(38,12), t timestamp_ntz", opts).alias("r")).select("record", "r.*")
    got = decode_records(quoted, "record", schema)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(d,StringType" in plan and "StructField(t,StringType" in plan  # neither is converted by the parser
    text = ["CAST(d AS STRING)", "CAST(t AS STRING)"]  # years beyond Python's
    got, want = ([tuple(r) for r in df.selectExpr(*text).collect()] for df in (got, want))
    assert [x for x in zip(pairs, got, want) if x[1] != x[2]] == []


@pytest.fixture()
def odd_orders(spark, workdir):
    """20,000 orders in no order: one in eight without a key, one in eight of the same key, odd dates and prices."""
    spark.range(20_000, numPartitions=3).selectExpr(
        "CASE id % 8 WHEN 0 THEN NULL WHEN 1 THEN 77 ELSE id * 7919 % 20011 END AS o_orderkey",
        "CASE WHEN id % 9 > 0 THEN abs(xxhash64(id, 1)) % 15000 END AS o_custkey",
        "CASE WHEN id % 11 > 0 THEN substr('OFP', 1 + CAST(id % 3 AS INT), 1) END AS o_orderstatus",
        "CASE id % 700 WHEN 0 THEN NULL WHEN 1 THEN -0.01 WHEN 2 THEN 999999999999.99 ELSE abs(xxhash64(id, 2)) % 50000000 / 100 END "
        "AS o_totalprice",
        "CASE id % 700 WHEN 0 THEN NULL WHEN 1 THEN TIMESTAMP_NTZ'0001-01-01 00:00:00' WHEN 2 THEN TIMESTAMP_NTZ'1969-12-31 23:59:59.5' "
        "WHEN 3 THEN TIMESTAMP_NTZ'1969-12-31 23:59:59.000001' WHEN 4 THEN TIMESTAMP_NTZ'1582-10-10 12:00:00' "
        "ELSE dateadd(day, CAST(abs(xxhash64(id, 3)) % 2400 AS INT), TIMESTAMP_NTZ'1995-01-01 00:00:00') END AS o_orderdate",
        "element_at(array('1-URGENT', '5-LOW', ' ', NULL), 1 + CAST(id % 4 AS INT)) AS o_orderpriority",
    ).write.parquet(f"{workdir}/orders.parquet")
    return workdir


def test_wide_source_is_stored_small_in_key_order_over_all_files(spark, odd_orders):
    src = spark.table(queries._wide_source(spark, odd_orders))
    want = spark.read.parquet(f"{odd_orders}/orders.parquet").selectExpr(*queries.wide_document_exprs("spark"))
    assert src.columns == want.columns and src.exceptAll(want).isEmpty() and want.exceptAll(src).isEmpty()
    parts = [(r.least, r.most) for r in src.select(F.input_file_name().alias("file"), F.coalesce("ctl_csn", F.lit(-1)).alias("key"))
             .groupBy("file").agg(F.min("key").alias("least"), F.max("key").alias("most")).collect()]
    parts.sort()
    assert len(parts) > 1 and all(a[1] <= b[0] for a, b in zip(parts, parts[1:]))  # ranges meet at their ends at most
    assert sum(os.path.getsize(local_path(p).removeprefix("//")) for p in src.inputFiles()) < 450 * 20_000


def test_rows_of_one_key_part(spark, workdir):
    spark.range(4000).selectExpr("CAST(NULL AS LONG) AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "1.5D AS o_totalprice",
                                 "TIMESTAMP_NTZ'1995-03-01 00:00:00' AS o_orderdate", "'5-LOW' AS o_orderpriority"
                                 ).write.parquet(f"{workdir}/orders.parquet")
    src = spark.table(queries._wide_source(spark, workdir))
    sizes = [r["count"] for r in src.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 2000


def test_wide_copies_of_no_rows(spark, workdir):
    spark.createDataFrame([], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                              "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{workdir}/orders.parquet")
    for query in (queries.wide_table_copy, queries.wide_snapshot_copy):
        got = query(spark, workdir)
        assert got.isEmpty() and len(got.columns) == 163


def test_pages_of_wide_storage_end_by_their_bytes(spark, workdir):
    """60,000 rows in one file: three pages of each column before, and more bytes."""
    rows = spark.range(60_000, numPartitions=1).selectExpr(
        "CAST(id AS DECIMAL(38,12)) AS k", "concat('c_series:', id) AS s",
        "timestampadd(MICROSECOND, id, dateadd(day, CAST(abs(xxhash64(id)) % 2400 AS INT), TIMESTAMP_NTZ'1995-01-01 00:00:00')) AS t")
    src, dst = queries._stage_table(spark, rows, "paged_source"), unique_name("paged_copy")
    columns = [("k", "decimal(38,12)"), ("s", "string"), ("t", "timestamp")]
    got = jobs.snapshot_copy(spark, src, dst, columns=columns, location=f"{workdir}/copy", options=queries.WIDE_STORAGE)
    assert got.count() == 60_000 and got.exceptAll(rows).isEmpty()
    cut = f"{workdir}/cut"
    spark.table(src).write.options(**{**queries.WIDE_STORAGE, "parquet.page.row.count.limit": "20000"}).parquet(cut)
    (now,), (was,) = ([pq.ParquetFile(f).metadata.row_group(0) for f in found] for found in
                      ([p.removeprefix("file://") for p in got.inputFiles()], files(cut, ".parquet")))
    sizes = [(now.column(i).total_compressed_size, was.column(i).total_compressed_size) for i in range(3)]
    assert sizes[1][0] < 0.5 * sizes[1][1] and sizes[2][0] < 0.9 * sizes[2][1] and sizes[0][0] <= sizes[0][1]
