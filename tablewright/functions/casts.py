"""Typed comparison over untyped text.

Under ANSI mode (the Spark 4 default) ``'abc' < 7`` raises CAST_INVALID_INPUT,
while a Hive text table would give null.  Jobs choose: ``on_bad_value="error"``
keeps ANSI, ``"null"`` uses ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def typed(col: Column | str, dtype: str, on_bad_value: str = "error") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if on_bad_value == "error":
        return c.cast(dtype)
    if on_bad_value == "null":
        return c.try_cast(dtype)
    raise ValueError(f"on_bad_value must be 'error' or 'null', got {on_bad_value!r}")
