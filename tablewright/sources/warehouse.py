"""Warehouse tables over JDBC.

The vendor connector is used when its format name is given and its jar is on
the classpath; otherwise the generic ``jdbc`` source.  Connection details and
credentials are always options from the caller — never constants here.

A JDBC read is one task unless it is split: give ``partition_column`` (a
numeric, date or timestamp column) and ``num_partitions``; the bounds, if not
given, come from one ``min``/``max`` query that runs in the warehouse.  The
bounds only spread the ranges — every row is read whatever they are.  At
warehouse scale the vendor's unload-to-storage connector beats JDBC; this
module stays with the JDBC contract so that any database works.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    opts.update({k: str(v) for k, v in (options or {}).items()})
    return opts


def bounds(spark: SparkSession, url: str, table: str, column: str,
           options: Mapping[str, str] | None = None) -> tuple[object, object]:
    """(min, max) of ``column``, computed by the warehouse, one row back."""
    probe = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds_q"
    row = (
        spark.read.format("jdbc")
        .options(**jdbc_options(url, probe, options))
        .load()
        .collect()[0]
    )
    return row["lo"], row["hi"]


def partition_options(column: str, lower: object, upper: object, num_partitions: int) -> dict[str, str]:
    """Options that split a JDBC read into ``num_partitions`` range queries.

    The bounds only decide the stride; the first and last ranges are open,
    so rows outside [lower, upper] are still read.
    """
    if num_partitions < 1:
        raise ValueError("num_partitions must be >= 1")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(num_partitions),
    }


def read_warehouse(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    options: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    lower_bound: object = None,
    upper_bound: object = None,
    fetch_size: int = 10_000,
    fmt: str = "jdbc",
) -> DataFrame:
    opts = jdbc_options(url, table, options)
    opts.setdefault("fetchsize", str(fetch_size))
    if partition_column:
        if not num_partitions:
            raise ValueError("num_partitions is required with partition_column")
        if lower_bound is None or upper_bound is None:
            lower_bound, upper_bound = bounds(spark, url, table, partition_column, options)
        if lower_bound is not None:  # an empty table needs no split
            opts.update(partition_options(partition_column, lower_bound, upper_bound, num_partitions))
    return spark.read.format(fmt).options(**opts).load()
