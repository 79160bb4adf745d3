"""Helpers shared by the text operators: tables, whole-text Arrow passes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import new_work_dir

SLICE_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_table(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written rows are a fact: whatever reads them later sees the same
    rows, and a lost executor costs no recomputation of what came before.
    """
    path = new_work_dir(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: dict[tuple, object] = {}


def kept_by_worker(key: tuple, build: Callable[[], object]):
    """What ``build`` gives, kept by this worker process from task to task;
    only the latest one stays, so that stages do not add up in memory."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def let_go() -> None:
    _KEPT.clear()


def slices(batch: pa.RecordBatch, column: int, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose ``column`` holds about ``max_bytes``
    (one row at least), so that what is derived from a run stays small."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = used = 0
    for i, b in enumerate(sizes):
        if i > start and used + b > max_bytes:
            yield batch.slice(start, i - start)
            start, used = i, 0
        used += b
    yield batch.slice(start, n - start)


def map_texts(df: DataFrame, schema: str, work: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
              column: int = 1, keeps: bool = False) -> DataFrame:
    """Arrow pass over ``df`` in bounded slices.

    ``work`` runs once per task and returns the function for a slice.  Unless
    it ``keeps`` something itself, what an earlier stage's tasks kept in the
    worker is let go first.
    """
    def run(batches):
        if not keeps:
            let_go()
        fn = work()
        for batch in batches:
            for part in slices(batch, column):
                yield fn(part)

    return df.mapInArrow(run, schema)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
