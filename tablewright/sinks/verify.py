"""Verified copies: a fingerprint of what is written against what is there.

The fingerprint of a table is independent of the order of its rows and needs
no key: per group of columns, every row is hashed twice to 64 bits, and the
hashes are summed exactly.  A dropped, doubled or changed row changes the sums
of the groups it touches (two independent 64-bit sums: an accident goes
unnoticed with a probability of about 2**-128).  The sums are taken in the
writing pass itself (``Dataset.observe``), so the source is read once; the
written table is read back and compared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType, VariantType

from tablewright.errors import CapabilityError, SchemaMismatchError, TableJobError
from tablewright.sinks.guards import positional_diff
from tablewright.sinks.tables import _typed, insert_overwrite

GROUP = 16  # columns of a group, if none are given
SEEDS = (0x5EED, 0xC0FFEE)


class VerificationError(TableJobError):
    """The written table does not hold the rows that were written."""

    def __init__(self, message: str, groups: list[list[str]], rows: tuple[int, int]):
        super().__init__(message)
        self.groups = groups
        self.rows = rows


def column_groups(columns: Sequence[str], size: int = GROUP) -> list[list[str]]:
    return [list(columns[i : i + size]) for i in range(0, len(columns), size)]


def _hashable(kind: DataType, name: str) -> None:
    if isinstance(kind, (MapType, VariantType)):
        raise CapabilityError(f"column {name}: {kind.simpleString()} has no fingerprint")
    for inner in ([f.dataType for f in kind.fields] if isinstance(kind, StructType) else
                  [kind.elementType] if hasattr(kind, "elementType") else []):
        _hashable(inner, name)


def fingerprint(schema: StructType, groups: list[list[str]]) -> list[Column]:
    """Aggregates: the number of rows and two sums per group of columns.

    A null is told apart from every value and from a null in another column.
    Sums are decimals of 38 digits, exact for up to 10**18 rows.
    """
    for f in schema.fields:
        _hashable(f.dataType, f.name)
    out = [F.count(F.lit(1)).alias("rows")]
    for i, names in enumerate(groups):
        parts = [p for n in names for p in (F.col(f"`{n}`"), F.col(f"`{n}`").isNull())]
        for j, seed in enumerate(SEEDS):
            out.append(F.coalesce(F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")), F.lit(0))
                       .cast("decimal(38,0)").alias(f"g{i}_{j}"))
    return out


def differing(groups: list[list[str]], wrote: dict, found: dict) -> list[list[str]]:
    return [g for i, g in enumerate(groups) if any(wrote[f"g{i}_{j}"] != found[f"g{i}_{j}"] for j in range(len(SEEDS)))]


def verified_write(df: DataFrame, write: Callable[[DataFrame], None], read: Callable[[], DataFrame],
                   groups: list[list[str]] | None = None, *, in_pass: bool = True) -> int:
    """``write(df)``, then compare ``read()`` with what passed through the write.

    ``write`` must be one DataFrame write that reads its rows once (a global
    sort reads them twice, to sample them); other writes, through RDDs, need
    ``in_pass=False``, which sums ``df`` in a pass of its own.  Returns the
    number of rows.  Raises ``VerificationError``, naming the
    groups of columns that differ, if a row was lost, doubled or changed on
    its way; ``read()`` must have the columns of ``df``.
    """
    groups = groups or column_groups(df.columns)
    missing = set(df.columns) - {n for g in groups for n in g}
    if missing:
        raise ValueError(f"columns without a group: {', '.join(sorted(missing))}")
    sums = fingerprint(df.schema, groups)
    if in_pass:
        seen = Observation("written")
        write(df.observe(seen, *sums))
        wrote = seen.get
    else:
        wrote = df.agg(*sums).first().asDict()
        write(df)
    back = read()
    if back.columns != df.columns:
        raise VerificationError(f"columns {back.columns} were read back, not {df.columns}", groups, (wrote["rows"], -1))
    found = back.agg(*sums).first().asDict()
    bad = differing(groups, wrote, found)
    if bad or wrote["rows"] != found["rows"]:
        raise VerificationError(
            f"{wrote['rows']} rows written, {found['rows']} found; differing columns: "
            + "; ".join(", ".join(g) for g in bad), bad, (wrote["rows"], found["rows"]))
    return wrote["rows"]


def verified_insert_overwrite(df: DataFrame, table: str, *, groups: list[list[str]] | None = None, **options) -> int:
    """``insert_overwrite`` with the written table compared to the rows that
    were written, typed as the table has them.  The table has been switched
    over by then: a difference is reported, not undone."""
    spark: SparkSession = df.sparkSession
    target = spark.table(table).schema

    diff = positional_diff(df.schema, target, match_names=options.get("match_names", True))
    if diff:  # before anything is cast
        raise SchemaMismatchError(f"insert into {table} refused", diff)
    return verified_write(_typed(df, target), lambda rows: insert_overwrite(rows, table, **options),
                          lambda: spark.table(table), groups)
