"""CSV reads that set malformed records aside instead of padding or cutting them.

Spark's parser flags a record whose number of fields is wrong or that holds a
value its column's type cannot take.  One pass over the files writes both
kinds, good rows and rejects, to one table in two partitions, and counts them
while it writes (``observe``): every record read is in one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tablewright.errors import TableJobError
from tablewright.functions.text import csv_options
from tablewright.session import new_work_dir

RECORD = "__record"
#: A value in quotes, quotes doubled inside; what is left of a record holds only real separators.
QUOTED = '"([^"]|"")*"'


@dataclass(frozen=True)
class Quarantine:
    """``good`` rows (the schema's columns), ``rejects`` (``file``, ``reason``,
    ``record``) and how many records were read, kept and rejected."""

    good: DataFrame
    rejects: DataFrame
    read: int
    kept: int
    rejected: int


def n_fields(record: Column, sep: str) -> Column:
    """Number of fields of a CSV record; quoted values count as one."""
    bare = F.regexp_replace(record, QUOTED, "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep) + 1


def reject_reason(record: Column, schema: StructType, sep: str, null_value: str | None) -> Column:
    """Why ``record`` does not fit ``schema``: its number of fields, or the
    first column whose type cannot take its value."""
    n = n_fields(record, sep).cast("int")
    texts = ", ".join(f"c{i} string" for i in range(len(schema.fields)))
    options = {k: v for k, v in csv_options(sep, null_value).items() if k != "header"}
    parsed = F.from_csv(record, texts, options)
    out = F.when(n < len(schema.fields), F.format_string(f"%d of {len(schema.fields)} fields", n))
    out = out.when(n > len(schema.fields), F.format_string(f"%d fields, not {len(schema.fields)}", n))
    for i, f in enumerate(schema.fields):
        if not isinstance(f.dataType, StringType):
            value = parsed[f"c{i}"]
            out = out.when(value.isNotNull() & value.try_cast(f.dataType).isNull(),
                           F.lit(f"{f.name}: not {f.dataType.simpleString()}"))
    return out.otherwise(F.lit("unreadable"))


def quarantine_csv(spark: SparkSession, path: str | list[str], schema: StructType | str, target: str | None = None, *,
                   header: bool = False, sep: str = ",", null_value: str | None = None,
                   max_rejected: int | None = None) -> Quarantine:
    """Read CSV under ``schema`` into ``target`` (a new folder; one under the
    shared folder if not given), malformed records apart.

    A record is rejected if it has fewer or more fields than the schema, or a
    value that is not of its column's type; nothing is padded, cut or made
    null.  ``reason`` says which.  Blank lines are no records.  With
    ``max_rejected`` more rejects than that raise (after the pass, with the
    counts; the rows stay in ``target``).  Header lines that differ from the
    schema fail the read.  Quoted line breaks are not supported here.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = target or new_work_dir(spark, "quarantine")
    parsed = StructType([*schema.fields, StructField(RECORD, StringType())])
    rows = (spark.read.schema(parsed).options(**csv_options(sep, null_value, header))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).option("enforceSchema", str(not header).lower())
            .csv(path))
    bad = F.col(RECORD).isNotNull()
    columns = [F.col(f"`{f.name}`").alias(f"v{i}") for i, f in enumerate(schema.fields)]
    counts = Observation("quarantine")
    parted = (rows.select(*columns, F.col(RECORD).alias("record"), F.when(bad, F.col("_metadata.file_path")).alias("file"),
                          bad.cast("int").alias("rejected"))
              .observe(counts, F.count(F.lit(1)).alias("read"), F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"))
              .withColumn("reason", F.when(F.col("rejected") == 1, reject_reason(F.col("record"), schema, sep, null_value))))
    parted.write.partitionBy("rejected").parquet(target)
    read, rejected = counts.get["read"], counts.get["rejected"]
    if max_rejected is not None and rejected > max_rejected:
        raise TableJobError(f"{rejected} of {read} records rejected, more than {max_rejected}; see {target}")
    stored = StructType([*(StructField(f"v{i}", f.dataType) for i, f in enumerate(schema.fields)),
                         StructField("record", StringType()), StructField("file", StringType()),
                         StructField("reason", StringType()), StructField("rejected", IntegerType())])
    back = spark.read.schema(stored).parquet(target)
    good = back.where("rejected = 0").select(*[F.col(f"v{i}").alias(f.name) for i, f in enumerate(schema.fields)])
    return Quarantine(good, back.where("rejected = 1").select("file", "reason", "record"), read, read - rejected, rejected)
