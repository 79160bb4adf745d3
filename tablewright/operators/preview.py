"""Bounded previews and schema reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """At most ``n`` rows as a DataFrame (what ``show``/``display`` print).

    With ``order_by`` the rows are the first ``n`` in that order, computed as
    a top-k (per-task heaps, no full sort); without it, any ``n`` rows.
    """
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """``printSchema`` as data: ordinal, name, type, nullable (one row per column)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, name string, type string, nullable boolean")
