"""Filters.  All stay Catalyst expressions, so they reach the scan."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def where_equals(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Exact, case- and space-sensitive equality; nulls never match."""
    return df.where(F.col(column) == F.lit(value))


def where_sql(spark: SparkSession, view: str, predicate: str,
              args: Mapping[str, Any] | None = None) -> DataFrame:
    """``SELECT * FROM view WHERE predicate`` with named, typed parameters.

    The predicate is the job's own SQL (``catid < :limit``); values come in
    through ``args`` and are bound, never formatted into the text.
    """
    return spark.sql(f"SELECT * FROM {view} WHERE {predicate}", args=dict(args or {}))
