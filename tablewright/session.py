"""Session helpers: shared work folders, capability probes.

Staged files and lineage cuts go under the shared folder the cluster names in
``spark.checkpoint.dir``.  Only a local-mode session without that setting gets
a folder of its own (tests); a cluster session without it is refused, because
a machine-local folder is invisible to the other executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tablewright.errors import CapabilityError

_SUBDIR = "tablewright"


def spark_context(spark: SparkSession):
    """The SparkContext, or None in a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def require_context(spark: SparkSession, what: str):
    sc = spark_context(spark)
    if sc is None:
        raise CapabilityError(f"{what} needs a classic Spark session (RDD API); "
                              "not available over Spark Connect")
    return sc


def shared_dir(spark: SparkSession) -> str:
    """Base folder for staged data, read from the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark_context(spark)
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        if sc is None or not sc.master.startswith("local"):
            raise CapabilityError(
                "spark.checkpoint.dir is not set; table jobs need a folder that "
                "every executor can reach (e.g. an object-store prefix)"
            )
        base = tempfile.mkdtemp(prefix="tablewright-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared folder."""
    return f"{shared_dir(spark)}/{_SUBDIR}/{label}-{uuid.uuid4().hex[:12]}"


def unique_name(label: str) -> str:
    """Catalog-safe unique table name, so repeated runs never collide."""
    return f"{label}_{uuid.uuid4().hex[:10]}"


def has_avro(spark: SparkSession) -> bool:
    """True when the ``avro`` data source resolves in this session.

    Resolving a path-less read with a declared schema looks the source up
    without touching any file.
    """
    try:
        spark.read.format("avro").schema("probe int").load()
        return True
    except Exception as e:  # AnalysisException: DATA_SOURCE_NOT_FOUND
        text = str(e)
        return not ("DATA_SOURCE_NOT_FOUND" in text or "Failed to find data source" in text)


def write_once(df, label: str):
    """``df`` written to the shared folder and read back: its rows, and what
    was derived from their place, are then the same for every later reader."""
    spark = df.sparkSession
    path = new_work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def require_shared_warehouse(spark: SparkSession, table: str) -> None:
    """Refuse to create ``table`` without a location where the warehouse is a
    folder of one machine: other executors could not read its files."""
    sc = spark_context(spark)
    root = spark.conf.get("spark.sql.warehouse.dir", "") or ""
    if sc is not None and not sc.master.startswith("local") and (root.startswith("file:") or "://" not in root):
        raise CapabilityError(f"table {table}: give a location; spark.sql.warehouse.dir ({root}) is a folder of one machine")
