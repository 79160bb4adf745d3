"""Column-level helpers.  All are built-in Spark expressions (JVM side)."""

from tablewright.functions.casts import typed
from tablewright.functions.charset import (
    is_standard_charset,
    outside_charset,
)
from tablewright.functions.checks import fail_if
from tablewright.functions.text import (
    csv_options,
    decode_records,
    encode_records,
)

__all__ = [
    "csv_options",
    "decode_records",
    "encode_records",
    "fail_if",
    "is_standard_charset",
    "outside_charset",
    "typed",
]
