"""Writers.  Every overwrite is guarded against replacing its own input."""

from tablewright.sinks.avro import write_avro
from tablewright.sinks.csv import write_csv
from tablewright.sinks.delimited import count_unwritable, write_delimited
from tablewright.sinks.guards import (
    assert_not_reading,
    positional_diff,
    qualify,
)
from tablewright.sinks.sequence import write_sequence
from tablewright.sinks.tables import insert_overwrite
from tablewright.sinks.warehouse import write_warehouse

__all__ = [
    "assert_not_reading",
    "count_unwritable",
    "insert_overwrite",
    "positional_diff",
    "qualify",
    "write_avro",
    "write_csv",
    "write_delimited",
    "write_sequence",
    "write_warehouse",
]
