"""In-line data checks: fail the write on the first bad value, in one pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fail_if(value: Column, condition: Column, message: str) -> Column:
    """``value`` unchanged, or a task failure where ``condition`` holds.

    Runs inside the writing stage, so checking costs no extra scan; a failed
    write job is not committed, so the target keeps no partial output.
    """
    return F.when(condition, F.raise_error(F.lit(message))).otherwise(value)


def holds_any(col: Column, chars: str) -> Column:
    """True where the string contains any of ``chars``."""
    cond = F.lit(False)
    for ch in chars:
        cond = cond | F.coalesce(F.instr(col, ch) > 0, F.lit(False))
    return cond
