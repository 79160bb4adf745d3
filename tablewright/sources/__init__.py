"""Readers.  Each returns a lazy DataFrame; nothing is pulled to the driver."""

from tablewright.sources.avro import read_avro
from tablewright.sources.csv import (
    header_clashes,
    read_csv_header,
    read_csv_positional,
    read_csv_typed,
)
from tablewright.sources.delimited import read_delimited
from tablewright.sources.sequence import read_sequence
from tablewright.sources.tables import read_table
from tablewright.sources.warehouse import read_warehouse

__all__ = [
    "header_clashes",
    "read_avro",
    "read_csv_header",
    "read_csv_positional",
    "read_csv_typed",
    "read_delimited",
    "read_sequence",
    "read_table",
    "read_warehouse",
]
