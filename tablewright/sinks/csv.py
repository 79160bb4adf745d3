"""CSV sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablewright.functions.checks import fail_if
from tablewright.functions.text import csv_options
from tablewright.sinks.guards import assert_not_reading
from tablewright.sinks.replace import replace_path
from tablewright.sqltext import ident


def _exact(df: DataFrame, null_value: str | None, on_empty: str) -> DataFrame:
    """Values that would be read back as another one fail the write."""
    lost = null_value if null_value is not None else "" if on_empty == "error" else None
    if lost is None:
        return df
    cols = []
    for f in df.schema.fields:
        c = F.col(ident(f.name))
        if isinstance(f.dataType, StringType):
            c = fail_if(c, c == F.lit(lost), f"column {f.name}: {lost!r} would be read back as null")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    header: bool = False,
    mode: str = "overwrite",
    sep: str = ",",
    null_value: str | None = None,
    sources: list[str] = (),
    compression: str | None = None,
    on_empty: str = "null",
    options: Mapping[str, str] | None = None,
) -> None:
    """Write ``df`` as CSV, one file per task (no funnel through one task).

    ``header=False`` matches a plain ``write.csv`` (names are not kept);
    microsecond timestamps, kept whitespace and RFC-4180 quote doubling are
    always on.  Without ``null_value`` an empty string is read back as null;
    ``on_empty="error"`` fails the write on one instead.  With ``null_value``
    (given to the reader too) empty strings survive, and a value equal to the
    marker fails the write.  ``compression`` (``gzip``, ``zstd``, …) and ``options``
    (others of Spark's CSV writer) apply to this write only.  An overwrite is atomic: a failed job leaves ``path`` as it
    was (``sinks.replace``).
    """
    if on_empty not in ("null", "error"):
        raise ValueError("on_empty must be 'null' or 'error'")
    df = _exact(df, null_value, on_empty)
    opts = csv_options(sep, null_value, header, line_sep="\n")
    if len(df.columns) == 1:
        # Spark's CSV reader skips lines that are blank after trimming, so a
        # one-column row holding null, "" or only whitespace would vanish;
        # quoting every value keeps each such line non-blank
        opts["quoteAll"] = "true"
    if compression:
        opts["compression"] = compression
    opts.update(options or {})
    if mode != "overwrite":
        df.write.mode(mode).options(**opts).csv(path)
        return
    spark = df.sparkSession
    assert_not_reading(spark, df, path, list(sources))
    replace_path(spark, path, lambda staging: df.write.options(**opts).csv(staging))
