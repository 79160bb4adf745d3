"""Catalog and session operations: views, table DDL, loads.

Everything is plain Spark SQL DDL so it works with the in-memory catalog and
with a Hive metastore alike.  Tables are created with an explicit location;
without one the catalog's warehouse folder is used, and refused on a cluster
if that is a folder of one machine (``session.require_shared_warehouse``).
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tablewright.functions.text import HIVE_NULL
from tablewright.schemas import ddl
from tablewright.sqltext import string
from tablewright.session import new_work_dir, require_shared_warehouse
from tablewright.sinks.replace import delete_path, make_dirs, upload_local_file
from tablewright.sinks.tables import insert_overwrite, table_meta
from tablewright.sources.delimited import (
    NO_QUOTE,
    delimited_options,
    enable_charset,
    read_delimited,
    require_line_based,
)


def _options_sql(options: Mapping[str, str]) -> str:
    return ", ".join(f"{string(k)} = {string(v)}" for k, v in options.items())


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Bind (or re-bind) a session view.  Frames built earlier keep their plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS`` — also for scripts that dropped unguarded."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(
    spark: SparkSession,
    name: str,
    columns: list[tuple[str, str]],
    *,
    provider: str = "parquet",
    location: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """``CREATE TABLE name (cols) USING provider [OPTIONS] [LOCATION]``."""
    sql = f"CREATE TABLE {name} ({ddl(columns)}) USING {provider}"
    if options:
        sql += f" OPTIONS ({_options_sql(options)})"
    if not location:
        require_shared_warehouse(spark, name)
    else:
        sql += f" LOCATION {string(location)}"
        make_dirs(spark, location)  # an empty table is an empty folder, not a missing one
    spark.sql(sql)


def connector_table(spark: SparkSession, name: str, provider: str,
                    options: Mapping[str, str]) -> DataFrame:
    """External table over a data source (``USING jdbc``, ``csv``, …).

    The schema comes from the source.  Dropping the table later removes the
    catalog entry only; the data stays where it is.  A CSV table splits whole
    lines, as the CSV readers do (``functions.text.csv_options``).
    """
    if provider.lower() == "csv":
        options = {"columnPruning": "false", **options}
    spark.sql(f"CREATE TABLE {name} USING {provider} OPTIONS ({_options_sql(options)})")
    return spark.table(name)


def set_table_options(spark: SparkSession, name: str, options: Mapping[str, str]) -> None:
    """``ALTER TABLE … SET SERDEPROPERTIES`` — e.g. the text encoding.

    On a data-source table the properties are its reader/writer options.
    """
    if "encoding" in options:
        require_line_based(options["encoding"])
    spark.sql(f"ALTER TABLE {name} SET SERDEPROPERTIES ({_options_sql(options)})")
    if "encoding" in options:
        enable_charset(spark, options["encoding"])


def create_delimited_table(
    spark: SparkSession,
    name: str,
    columns: list[tuple[str, str]],
    location: str,
    *,
    sep: str = "\t",
    charset: str = "UTF-8",
) -> None:
    """A new text table: ``ROW FORMAT DELIMITED FIELDS TERMINATED BY sep``."""
    require_line_based(charset)
    create_table(spark, name, columns, provider="csv", location=location, options=delimited_options(sep, charset))
    enable_charset(spark, charset)


@contextmanager
def uploaded(spark: SparkSession, path: str, local: bool):
    """``path`` for the executors: a file on the driver's own disk is uploaded
    into the shared folder while the block runs."""
    if not local:
        yield path
        return
    staged = new_work_dir(spark, "load-data-local")
    try:
        upload_local_file(spark, path, staged)
        yield staged
    finally:
        delete_path(spark, staged)


def read_text_table(spark: SparkSession, table: str) -> DataFrame:
    """A delimited text table read as Hive reads it: an empty field is ``''``
    and the null marker null.  (``spark.table`` goes through the CSV reader,
    which gives null for both.)"""
    meta = table_meta(spark, table)
    return read_delimited(spark, meta.location, spark.table(table).schema, **_layout(meta))


def _layout(meta) -> dict:
    return {"sep": meta.options.get("sep", "\t"), "charset": meta.options.get("encoding", "UTF-8"),
            "null_value": meta.options.get("nullValue", HIVE_NULL),
            "quoted": meta.options.get("quote", NO_QUOTE) != NO_QUOTE}


def load_file_overwrite(spark: SparkSession, table: str, path: str, *,
                        charset: str | None = None, local: bool = False) -> None:
    """``LOAD DATA [LOCAL] INPATH path OVERWRITE INTO TABLE table`` for any session.

    A plain session refuses LOAD DATA on data-source tables, so the file is
    read with the table's own schema and options and the table's content is
    replaced by an insert.  The file is validated by the read, which LOAD
    DATA (a byte copy) never did; the source file is left in place.

    ``local=True`` is ``LOAD DATA LOCAL``: ``path`` is on the driver's own
    disk, which executors of a cluster cannot see, so it is first uploaded
    into the shared folder (as the client-side upload of LOAD DATA LOCAL).
    """
    meta = table_meta(spark, table)
    layout = _layout(meta)
    if charset:
        layout["charset"] = charset
    with uploaded(spark, path, local) as source:
        insert_overwrite(read_delimited(spark, source, spark.table(table).schema, **layout), table)
