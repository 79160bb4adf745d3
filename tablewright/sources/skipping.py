"""Data skipping for CSV files: what each file holds, kept beside the data.

Text files carry no statistics, so every filter reads every file.  A skip
index has one row per file: least and greatest value of each indexed column,
and a Bloom filter of its values.  A filter that compares such columns with
literals then lists only the files that can hold a matching row, before the
scan is planned.

An entry counts only for a file that still has the length and modification
time it was made from; files without a valid entry (changed, new, or left
out by an index that was not finished) are always read.  So a stale index
costs time, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from tablewright.errors import TableJobError
from tablewright.sources.csv import read_csv_typed

FOLDER = "_skipping"  # readers of the data skip names that begin with an underscore
BITS, PROBES = 1 << 15, 5
Condition = tuple[str, str, object]  # column, one of = < <= > >=, literal


def _places(value: Column) -> list[Column]:
    """The bits of a value in a Bloom filter."""
    a, b = F.pmod(F.xxhash64(value), F.lit(BITS)), F.pmod(F.xxhash64(value, F.lit(1)), F.lit(BITS))
    return [F.pmod(a + i * b, F.lit(BITS)).cast("int") for i in range(PROBES)]


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` (as readers take it), ``file``, ``size``, ``time`` of the data files; contents are not read."""
    return spark.read.format("binaryFile").load(path).select(
        "path", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("time"))


def build_skip_index(spark: SparkSession, path: str, schema: StructType | str, columns: Sequence[str], *,
                     header: bool = False, sep: str = ",", null_value: str | None = None) -> DataFrame:
    """Index ``columns`` of the CSV files in the folder ``path``; the index's rows.

    Values are compared and hashed as the types of ``schema``.  Empty files
    and columns of nulls have entries that match nothing.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    unknown = [c for c in columns if c not in schema.names]
    if unknown or any(isinstance(schema[c].dataType, BinaryType) for c in columns if c in schema.names):
        raise TableJobError(f"columns that cannot be indexed: {', '.join(unknown or columns)}")
    rows = read_csv_typed(spark, path, schema, header=header, sep=sep, null_value=null_value)
    rows = rows.select(F.col("_metadata.file_path").alias("__file"), *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)])
    bounds = rows.groupBy("__file").agg(*[f(f"v{i}").alias(f"{name}{i}") for i in range(len(columns))
                                          for f, name in ((F.min, "lo"), (F.max, "hi"))])
    # one row a file, column and word of 64 bits; combined within the task that reads the file
    bits = [F.struct(F.lit(i).alias("column"), p.alias("place")) for i in range(len(columns)) for p in _places(F.col(f"v{i}"))]
    known = F.filter(F.array(*bits), lambda b: reduce(
        lambda x, y: x | y, [(b["column"] == i) & F.col(f"v{i}").isNotNull() for i in range(len(columns))]))
    words = (rows.select("__file", F.explode(known).alias("b"))
             .groupBy("__file", "b.column", F.floor(F.col("b.place") / 64).cast("int").alias("word"))
             .agg(F.bit_or(_bit(F.col("b.place"))).alias("bits")))
    blooms = words.groupBy("__file").agg(*[F.map_from_entries(F.collect_list(
        F.when(F.col("column") == i, F.struct("word", "bits")))).alias(f"bloom{i}") for i in range(len(columns))])
    entries = _files(spark, path).join(bounds, F.col("file") == F.col("__file"), "left").drop("__file")
    entries = entries.join(blooms, F.col("file") == F.col("__file"), "left").drop("__file", "path")
    names = F.array(*[F.lit(c) for c in columns])
    out = f"{path.rstrip('/')}/{FOLDER}"
    entries.withColumn("columns", names).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def _bit(place: Column) -> Column:
    """The number whose only set bit is that of ``place`` in its word."""
    bits = [F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)]
    return F.get(F.array(*bits), (place % 64).cast("int"))


def _may_match(i: int, op: str, value: Column) -> Column:
    lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
    if op == "=":
        held = reduce(lambda x, y: x & y, [
            F.coalesce(F.try_element_at(f"bloom{i}", F.floor(p / 64).cast("int")), F.lit(0).cast("long"))
            .bitwiseAND(_bit(p)) != 0 for p in _places(value)])
        return (lo <= value) & (value <= hi) & held
    return {"<": lo < value, "<=": lo <= value, ">": hi > value, ">=": hi >= value}[op]


def files_to_read(spark: SparkSession, path: str, schema: StructType | str, conditions: Sequence[Condition]) -> tuple[list[str], int]:
    """The data files that can hold a row for which all ``conditions`` are
    true, and how many there are in all.  Conditions on columns that are not
    indexed, and nulls, exclude nothing."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    now = _files(spark, path)
    try:
        index = spark.read.parquet(f"{path.rstrip('/')}/{FOLDER}")
        columns = (index.select("columns").first() or [[]])[0]
    except AnalysisException:  # no index, or none that is complete
        index, columns = None, []
    test = F.lit(True)
    for column, op, value in conditions:
        if op not in ("=", "<", "<=", ">", ">="):
            raise ValueError(f"{op}: only = < <= > >= with a literal can be tested per file")
        if column in columns:
            test = test & _may_match(columns.index(column), op, F.lit(value).cast(schema[column].dataType))
    rows = now
    if columns:
        known = index.select(F.col("file"), "size", "time", F.coalesce(test, F.lit(False)).alias("may"))
        rows = now.join(known, ["file", "size", "time"], "left").where(F.coalesce("may", F.lit(True)))
    return sorted(r.path for r in rows.select("path").collect()), now.count()


def read_csv_skipping(spark: SparkSession, path: str, schema: StructType | str, conditions: Sequence[Condition], *,
                      header: bool = False, sep: str = ",", null_value: str | None = None) -> DataFrame:
    """The rows of the CSV files in ``path`` for which all ``conditions``
    (column, operator, literal) are true, from the files that can hold one."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    files, _ = files_to_read(spark, path, schema, conditions)
    if not files:
        return spark.createDataFrame([], schema)
    rows = read_csv_typed(spark, files, schema, header=header, sep=sep, null_value=null_value)
    for column, op, value in conditions:
        literal, c = F.lit(value).cast(schema[column].dataType), F.col(f"`{column}`")
        rows = rows.where({"=": c == literal, "<": c < literal, "<=": c <= literal, ">": c > literal, ">=": c >= literal}[op])
    return rows
