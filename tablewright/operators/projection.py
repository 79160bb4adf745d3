"""Projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_all(df: DataFrame) -> DataFrame:
    return df.select("*")


def project_positions(df: DataFrame, positions: Mapping[int, str]) -> DataFrame:
    """Pick columns by 0-based position and rename them, in the given order.

    On a headerless CSV the positions are the ``_cN`` columns; the reader
    then parses only those (column pruning reaches the CSV scan).
    """
    width = len(df.columns)
    bad = [p for p in positions if not 0 <= p < width]
    if bad:
        raise IndexError(f"positions {bad} outside the {width} columns of the input")
    return df.select(*[F.col(f"`{df.columns[p]}`").alias(name) for p, name in positions.items()])
