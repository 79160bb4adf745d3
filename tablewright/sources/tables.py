"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Full scan of ``db.table`` (or a view); pruning and pushdown are Catalyst's."""
    return spark.table(name)
