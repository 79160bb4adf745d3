"""Measurements for the README, median of N after a warm-up.

    python scripts/measure.py [sf_dir] [repeat]

Prints a markdown table.  Sizes are bytes on disk of the written data files.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tablewright.operators.windows import ranked_running_total  # noqa: E402
from tablewright.plans import jobs  # noqa: E402
from tablewright.queries import _stage_table, table, wide_document_exprs  # noqa: E402
from tablewright.schemas import WIDE_DOCUMENT_COLUMNS  # noqa: E402
from tablewright.session import new_work_dir, unique_name  # noqa: E402
from tablewright.sinks.csv import write_csv  # noqa: E402
from tablewright.sinks.delimited import write_delimited  # noqa: E402
from tablewright.sinks.sequence import write_sequence  # noqa: E402
from tablewright.sinks.tables import table_meta  # noqa: E402
from tablewright.sources.csv import read_csv_header, read_csv_positional  # noqa: E402
from tablewright.sources.delimited import read_delimited  # noqa: E402
from tablewright.sources.sequence import read_sequence  # noqa: E402


def du(path: str) -> int:
    p = path[len("file:"):] if path.startswith("file:") else path
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(p)
               for f in fs if not f.startswith(".") and not f.startswith("_"))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeat = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    noop = lambda d: d.write.format("noop").mode("overwrite").save()
    rows = []

    def timed(label, fn, size=None):
        fn()  # warm-up
        ts = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t0)
        rows.append((label, statistics.median(ts), size() if size else None))
        print(f"| {label} | {statistics.median(ts):.2f} | {size() if size else ''} |", flush=True)

    customer = table(spark, sf_dir, "customer")
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    cust_csv = new_work_dir(spark, "m-cust")
    write_csv(customer, cust_csv, header=True)
    li_csv = new_work_dir(spark, "m-li")
    write_csv(lineitem, li_csv)
    print("| measurement | median s | bytes |\n|---|---|---|")
    timed("CSV scan + filter (customer, header)", lambda: noop(
        read_csv_header(spark, cust_csv).where("c_mktsegment = 'BUILDING'")))
    timed("positional projection (lineitem CSV, 3 of 11 columns)", lambda: noop(
        read_csv_positional(spark, li_csv).select("_c8", "_c0", "_c9")))

    # the same rows in each format: write time (size), read time
    for label, write, read in [
        ("Parquet", lambda p: lineitem.write.mode("overwrite").parquet(p),
         lambda p: spark.read.parquet(p)),
        ("SequenceFile BLOCK", lambda p: write_sequence(lineitem, p, compression="BLOCK"),
         lambda p: read_sequence(spark, p, lineitem.schema)),
        ("SequenceFile NONE", lambda p: write_sequence(lineitem, p, compression="NONE"),
         lambda p: read_sequence(spark, p, lineitem.schema)),
        ("tab text", lambda p: write_delimited(lineitem, p),
         lambda p: read_delimited(spark, p, lineitem.schema)),
        ("tab text gzip", lambda p: write_delimited(lineitem, p, compression="gzip"),
         lambda p: read_delimited(spark, p, lineitem.schema)),
    ]:
        path = new_work_dir(spark, "m-fmt")
        timed(f"write lineitem as {label}", lambda w=write, p=path: w(p), lambda p=path: du(p))
        timed(f"read lineitem from {label}", lambda r=read, p=path: noop(r(p)))

    wide_src = _stage_table(spark, orders.selectExpr(*wide_document_exprs("spark")), "m_wide")
    dst = unique_name("m_wide_dst")
    loc = new_work_dir(spark, dst)
    timed("163-column copy → Parquet table", lambda: noop(
        jobs.snapshot_copy(spark, wide_src, dst, columns=WIDE_DOCUMENT_COLUMNS, location=loc)),
          lambda: du(table_meta(spark, dst).location))
    seq = jobs.SequenceTable(new_work_dir(spark, "m-wide-seq"), WIDE_DOCUMENT_COLUMNS)
    timed("163-column copy → SequenceFile BLOCK", lambda: noop(jobs.snapshot_copy(spark, wide_src, seq)),
          lambda: du(seq.path))

    # a key holding a third of all rows
    skewed = orders.select(
        "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.col("o_totalprice").cast("decimal(17,2)").alias("price"))
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    plain = skewed.select("*", F.row_number().over(w).alias("rn"),
                          F.sum("price").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rt"))
    ours = ranked_running_total(skewed, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")], "price")
    timed("plain window, hot key (1/3 of rows)", lambda: noop(plain))
    timed("ranked_running_total, hot key (1/3 of rows)", lambda: noop(ours))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    biggest_plain = (skewed.groupBy(F.pmod(F.hash("o_custkey"), F.lit(n)).alias("task")).count()
                     .agg(F.max("count")).first()[0])
    pieces = skewed.repartitionByRange(4 * n, "o_custkey", "o_orderdate", "o_orderkey") \
        .select("o_custkey", F.spark_partition_id().alias("piece"))
    biggest_ours = (pieces.groupBy(F.pmod(F.hash("o_custkey", "piece"), F.lit(n)).alias("task")).count()
                    .agg(F.max("count")).first()[0])
    total = skewed.count()
    print(f"\nlargest window task: plain {biggest_plain} of {total} rows; "
          f"ranked_running_total {biggest_ours} of {total} rows")
    spark.stop()


if __name__ == "__main__":
    main()
