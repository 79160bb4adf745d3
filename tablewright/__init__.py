"""tablewright — batch table jobs on Spark.

CSV, delimited text in legacy character sets, SequenceFile, Avro, catalog
and warehouse (JDBC) tables; projection, filtering, previews; positional
inserts with checks and overwrite guards.  Every job is a DataFrame/SQL plan
planned by Catalyst and executed on the executors.
"""

from tablewright.errors import (
    CapabilityError,
    EncodingError,
    SchemaMismatchError,
    SelfOverwriteError,
    TableJobError,
)
from tablewright.session import new_work_dir, shared_dir

__all__ = [
    "CapabilityError",
    "EncodingError",
    "SchemaMismatchError",
    "SelfOverwriteError",
    "TableJobError",
    "new_work_dir",
    "shared_dir",
]
