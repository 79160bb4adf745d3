"""Avro sink: only through the spark-avro data source.

Nothing else bundled with Spark can write Avro from a plain session, and this
library does not carry its own Avro encoder; without the module the write
fails loudly instead of writing some other format under an Avro name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablewright.errors import CapabilityError
from tablewright.session import has_avro
from tablewright.sinks.guards import assert_not_reading
from tablewright.sinks.replace import replace_path


def write_avro(df: DataFrame, path: str, *, mode: str = "overwrite", sources: list[str] = ()) -> None:
    spark = df.sparkSession
    if not has_avro(spark):
        raise CapabilityError(
            "Avro output needs the spark-avro module "
            "(--packages org.apache.spark:spark-avro_2.13:<spark version>)"
        )
    if mode != "overwrite":
        df.write.format("avro").mode(mode).save(path)
        return
    assert_not_reading(spark, df, path, list(sources))
    replace_path(spark, path, lambda staging: df.write.format("avro").save(staging))
