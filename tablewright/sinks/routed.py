"""One scan, several targets.

Every action on a DataFrame scans its source again, so writing a table and a
filtered copy of it costs two scans.  Here the rows are routed: each row is
given the numbers of the targets it belongs to, one pass writes all of them,
partitioned by number, and counts them, and then every partition's folder
becomes its target (``replace.replace_path``: whole, or not at all).

The targets change one after the other.  A job that fails while writing
changes none; a driver lost between two targets leaves the first new, the
second old and the rest of the pass in a hidden folder, and a second run sets
both right.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewright.errors import CapabilityError, SelfOverwriteError
from tablewright.sinks.guards import assert_not_reading, overlaps, qualify
from tablewright.sinks.replace import OBJECT_STORES, _fs, delete_path, hidden_sibling, replace_path

ROUTE = "__route"


def routed(df: DataFrame, conditions: list[Column | None]) -> DataFrame:
    """``df``'s rows, once per condition that holds (None: always), with its
    number in ``__route``."""
    numbers = [F.when(F.lit(True) if c is None else c, F.lit(i)) for i, c in enumerate(conditions)]
    return df.withColumn(ROUTE, F.explode(F.filter(F.array(*numbers), lambda n: n.isNotNull())))


def write_routed(df: DataFrame, targets: Mapping[str, Column | None]) -> dict[str, int]:
    """Write ``df`` to every folder of ``targets`` as Parquet, each with the rows
    for which its condition holds (None: all); rows per target.

    Null conditions exclude a row.  A target without rows becomes an empty
    table of ``df``'s columns.  Targets may not overlap, nor be read by ``df``.
    """
    spark: SparkSession = df.sparkSession
    folders = [qualify(spark, t) for t in targets]
    if ROUTE in df.columns:
        raise ValueError(f"the column name {ROUTE} is taken")
    for i, folder in enumerate(folders):
        if folder.split(":", 1)[0] in OBJECT_STORES:
            raise CapabilityError(f"{folder}: a folder rename is a copy on an object store")
        if any(overlaps(folder, other) for other in folders[:i]):
            raise SelfOverwriteError(f"two targets overlap at {folder}")
        assert_not_reading(spark, df, folder)
    if not folders:
        return {}
    counts = Observation("routed")
    rows = routed(df, list(targets.values()))
    rows = rows.observe(counts, *[F.count_if(F.col(ROUTE) == i).alias(f"r{i}") for i in range(len(folders))])
    staged = hidden_sibling(folders[0], "routed")
    try:
        rows.write.partitionBy(ROUTE).parquet(staged)
    except BaseException:
        delete_path(spark, staged)  # the failed attempt leaves nothing behind
        raise

    for i, folder in enumerate(folders):
        def move(to: str, i: int = i) -> None:
            source, fs = _fs(spark, f"{staged}/{ROUTE}={i}")
            if not fs.exists(source):
                df.limit(0).write.parquet(to)
                return
            parent, _ = _fs(spark, to.rpartition("/")[0])
            fs.mkdirs(parent)
            if not fs.rename(source, _fs(spark, to)[0]):
                raise OSError(f"could not move the rows of {folder}")

        replace_path(spark, folder, move)
    delete_path(spark, staged)
    return {t: counts.get[f"r{i}"] for i, t in enumerate(targets)}
