"""J1 as an incremental job over a landing folder.

Each run processes only the CSV files that arrived since the previous run
(``trigger(availableNow=True)``), then stops.  Progress lives in the
checkpoint folder (in the shared folder), and the file sink commits each
micro-batch to its metadata log, so a job restarted after losing the
driver or executors neither drops nor duplicates rows.  Readers of the
target see only committed files.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablewright.errors import TableJobError
from tablewright.functions.text import csv_options
from tablewright.params import bind
from tablewright.plans.jobs import FILTER_PARAMS
from tablewright.sources.csv import header_clashes, read_csv_header


def incremental_filter_csv_copy(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint: str,
    *,
    column: str = "Code",
    params: Mapping[str, Any] | None = None,
    names: list[str] | None = None,
    max_files_per_trigger: int | None = None,
    timeout_s: float | None = None,
) -> DataFrame:
    """Filter newly arrived headed CSV files into ``target_dir``.

    ``names`` fixes the header (all columns are strings); by default it is
    read from the first line of the landing folder.  ``max_files_per_trigger``
    splits a large backlog into several micro-batches (``availableNow`` still
    stops when the backlog is done).  Returns the whole target (all runs so
    far) as a batch frame.
    """
    if names is None:
        try:
            header = read_csv_header(spark, source_dir)
            clashes, names = header_clashes(header), header.columns
        except AnalysisException as e:
            raise TableJobError(f"no CSV file in {source_dir} to take the header from yet; "
                                "pass names=[...]") from e
        if any(c.lower() == column.lower() for c in clashes):
            raise TableJobError(f"header names {clashes} differ only in case; `{column}` is ambiguous")
    schema = StructType([StructField(n, StringType()) for n in names])
    value = bind(FILTER_PARAMS, params)["value"]
    reader = spark.readStream.schema(schema).options(**csv_options(header=True)).option(
        "enforceSchema", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.csv(source_dir)
    kept = stream.where(F.col(f"`{column}`") == F.lit(value))
    query = (
        kept.writeStream.format("csv")
        .options(**csv_options(line_sep="\n"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target_dir)
    )
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TableJobError(f"incremental run did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise TableJobError(str(query.exception()))
    return (spark.read.schema(schema).options(**csv_options(line_sep="\n"))
            .option("multiLine", "true").csv(target_dir))
