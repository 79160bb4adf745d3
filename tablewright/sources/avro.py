"""Avro files.

Route 1: the ``avro`` data source when spark-avro is on the classpath.
Route 2: without it, Avro's own ``AvroAsTextInputFormat`` (avro-mapred ships
with Spark) turns each record into one JSON line on the executors, and the
JSON reader types it; each line passes through Python once.  Columns, their
order and their types are those of the writer's schema, taken from the header
of one file.  Types that the text route cannot carry exactly (bytes, fixed,
logical types such as decimals and timestamps, unions of several types) are
refused by name.  That route only sees files whose names end in ``.avro``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from tablewright.errors import CapabilityError, TableJobError
from tablewright.session import has_avro, require_context

_AS_TEXT = "org.apache.avro.mapred.AvroAsTextInputFormat"
_PRIMITIVES = {"string": StringType(), "int": IntegerType(), "long": LongType(), "float": FloatType(),
               "double": DoubleType(), "boolean": BooleanType()}


def spark_type(avro, where: str = "record") -> DataType:
    """The Spark type of an Avro schema (parsed JSON), or a refusal."""
    if isinstance(avro, list):
        rest = [a for a in avro if a != "null"]
        if len(rest) == 1:
            return spark_type(rest[0], where)
        raise CapabilityError(f"{where}: a union of several types needs the spark-avro module")
    if isinstance(avro, str):
        avro = {"type": avro}
    kind = avro["type"]
    if isinstance(kind, (list, dict)):
        return spark_type(kind, where)
    if "logicalType" in avro:
        raise CapabilityError(f"{where}: logical type {avro['logicalType']} needs the spark-avro module")
    if kind in _PRIMITIVES:
        return _PRIMITIVES[kind]
    if kind == "enum":
        return StringType()
    if kind == "array":
        return ArrayType(spark_type(avro["items"], f"{where}[]"))
    if kind == "map":
        return MapType(StringType(), spark_type(avro["values"], f"{where}{{}}"))
    if kind == "record":
        return StructType([StructField(f["name"], spark_type(f["type"], f"{where}.{f['name']}"))
                           for f in avro["fields"]])
    raise CapabilityError(f"{where}: type {kind} needs the spark-avro module")


def writer_schema(spark: SparkSession, path: str) -> StructType:
    """The schema in the header of the first ``.avro`` file of ``path``."""
    sc = require_context(spark, "Avro input without spark-avro")
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    files = [s.getPath() for s in fs.listStatus(root) if s.isFile() and s.getPath().getName().endswith(".avro")]
    if not files:
        raise TableJobError(f"no .avro file in {path}")
    reader = jvm.org.apache.avro.file.DataFileReader.openReader(
        jvm.org.apache.avro.mapred.FsInput(min(files, key=lambda p: p.getName()), conf),
        jvm.org.apache.avro.generic.GenericDatumReader())
    try:
        return spark_type(json.loads(reader.getSchema().toString()))
    finally:
        reader.close()


def read_avro(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    if has_avro(spark):
        reader = spark.read.format("avro")
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(path)
    written = writer_schema(spark, path)  # also refuses what the text route cannot carry
    lines = require_context(spark, "Avro input without spark-avro").hadoopFile(
        path, _AS_TEXT, "org.apache.hadoop.io.Text", "org.apache.hadoop.io.NullWritable"
    ).map(lambda kv: kv[0])
    return spark.read.schema(written if schema is None else schema).json(lines)
