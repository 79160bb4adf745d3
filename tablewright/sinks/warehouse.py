"""Warehouse (JDBC) sink.

Writes run one connection per task; ``num_partitions`` caps the number of
concurrent connections (Spark coalesces to it).  ``truncate`` keeps the
table definition on overwrite instead of drop-and-recreate.  Writing back
into the table being read is refused: JDBC would truncate it first and the
read would then see nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tablewright.errors import SelfOverwriteError
from tablewright.sources.warehouse import jdbc_options


def write_warehouse(
    df: DataFrame,
    url: str,
    table: str,
    *,
    options: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    truncate: bool = True,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
    source: tuple[str, str] | None = None,
    fmt: str = "jdbc",
) -> None:
    if source is not None and mode == "overwrite":
        s_url, s_table = source
        if s_url == url and s_table.lower() == table.lower():
            raise SelfOverwriteError(f"refusing to overwrite {table}: it is the job's source")
    opts = jdbc_options(url, table, options)
    opts.update({"truncate": str(truncate).lower(), "batchsize": str(batch_size)})
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    df.write.format(fmt).options(**opts).mode(mode).save()
