"""CSV sources: by header, by position, or through a declared schema.

Header and positional reads give every column as a string, as in the jobs
they come from.  Catalyst pushes filters into the CSV parser and prunes the
columns to those the plan uses; the parser splits whole lines
(``functions.text.csv_options``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablewright.functions.text import csv_options


def _reader(spark: SparkSession, header: bool, multiline: bool, escape: str):
    return (spark.read.options(**csv_options(header=header))
            .option("multiLine", str(multiline).lower()).option("escape", escape))


def read_csv_header(spark: SparkSession, path: str | list[str], *, multiline: bool = False,
                    escape: str = '"') -> DataFrame:
    """Names from the first line, all values strings (``_c`` names never appear).

    ``multiline=True`` is needed when quoted values hold line breaks; it
    makes every file one task (a record may cross any byte offset), so it is
    off by default and large files stay splittable.  ``escape='"'`` reads
    RFC-4180 files (quotes doubled); files from Spark's default CSV writer
    escape quotes with a backslash and need ``escape="\\"``.

    Spark pairs the columns of several files by position under the names of
    one of them.  Every file's header is compared with those names, and a file
    that differs fails the read (``header_error``) instead of losing rows.
    Files whose header Spark has to rename (empty names, names that differ
    only in case) cannot be compared; their clashes are reported by
    ``header_clashes``.
    """
    reader = _reader(spark, True, multiline, escape)
    found = reader.csv(path)
    if header_clashes(found) or any(re.fullmatch(r"_c\d+", c) for c in found.columns):
        return found
    return reader.schema(found.schema).option("enforceSchema", "false").csv(path)


def header_error(e: Exception) -> bool:
    """Did a read fail because a file's header differs from the others'?"""
    return "CSV header does not conform to the schema" in str(e)


def read_csv_positional(spark: SparkSession, path: str | list[str], *, multiline: bool = False,
                        escape: str = '"') -> DataFrame:
    """No header: columns are ``_c0 … _cN`` and a header line, if any, is data."""
    return _reader(spark, False, multiline, escape).csv(path)


def read_csv_typed(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    *,
    header: bool = False,
    null_value: str | None = None,
    sep: str = ",",
    mode: str = "PERMISSIVE",
    multiline: bool = False,
    line_sep: str | None = None,
) -> DataFrame:
    """Declared schema; ``mode="FAILFAST"`` turns ragged or bad rows into errors.

    ``multiline`` is needed when quoted values hold line breaks; each file is
    then read by one task (a record may cross any byte offset).  Give
    ``line_sep="\\n"`` for files this library wrote, to keep ``\\r`` inside
    values exact.
    """
    return (
        spark.read.schema(schema)
        .options(**csv_options(sep, null_value, header, line_sep))
        .option("mode", mode)
        .option("multiLine", str(multiline).lower())
        .csv(path)
    )


def header_clashes(df: DataFrame) -> list[str]:
    """Header names that differ only in case, as read into ``df``.

    Spark renames such columns by appending their position (``Code`` and
    ``code`` in columns 0 and 1 become ``Code0`` and ``code1``) without a
    word; a job that filters on ``Code`` would then fail or pick the wrong
    column.  Read off the inferred names, so no second listing of the input
    and no extra job is needed.
    """
    groups: dict[str, list[str]] = {}
    for i, name in enumerate(df.columns):
        suffix = str(i)
        if len(name) > len(suffix) and name.endswith(suffix):
            base = name[: -len(suffix)]
            groups.setdefault(base.lower(), []).append(base)
    return sorted(b for bases in groups.values() if len(bases) > 1 for b in bases)
