"""Ranking and running totals per key, safe against hot keys.

``row_number()`` and a running ``sum`` over ``PARTITION BY key ORDER BY …``
put every row of a key into one task; a key holding a third of the table
makes that task a third of the job.  This operator splits keys instead:

1. range-partition the rows on (key, order…) into ranges — Spark samples the
   sort keys, so a hot key is cut into several ranges by its order columns —
   and write them, with their range, to the shared folder.  The range of a row
   is thereby a fact: a plan that computed it twice would sample twice and
   get other bounds;
2. number and sum within each (key, range) piece with an ordinary window —
   no piece is larger than one range;
3. fix up the pieces that continue a key from earlier ranges.  The rows are
   sorted by key, so only a range's *first* key can have rows in earlier
   ranges, and those earlier rows are the *last* key of each preceding range
   in an unbroken run.  One summary row per range (first row, last key and
   that key's local count and sum) is enough to compute every offset; the
   offsets table has at most one row per range, a proven bound, so it is
   broadcast and the big side is not shuffled for the join.

Cost: one range shuffle and one write of the input, one hash shuffle for the
pieces, and aggregates and windows over at most one row per range.  Pieces are placed on
tasks by hash, so there are four ranges per task by default: smaller pieces
even out the placement (measured at sf0.1 with one key holding a third of
the rows: largest task 62.7k rows with a plain window, 41.6k with one range
per task, 27.2k with four; ideal 18.75k).

Sums are exact when ``value`` is decimal or integral; a floating-point
running sum depends on the order of additions.  Order columns are ascending
and must make rows unique within a key, as for any row_number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from tablewright.session import write_once

_PIECE = "__piece"


def _total_type(df: DataFrame, value: str) -> str:
    t = df.schema[value].dataType
    if isinstance(t, DecimalType):
        return f"decimal(38,{t.scale})"
    if isinstance(t, (DoubleType, FloatType)):
        return "double"
    return "bigint"


def ranked_running_total(
    df: DataFrame,
    key: str | list[str],
    order: list[str | Column],
    value: str,
    *,
    rank_col: str = "rn",
    total_col: str = "running_total",
    num_ranges: int | None = None,
) -> DataFrame:
    """Add ``rank_col`` (1-based row number) and ``total_col`` (running sum).

    ``key`` is one column or several (``PARTITION BY a, b``); several are
    carried as one struct, which orders and compares field by field with
    nulls first and null equal to null, as a window's partitioning does.
    """
    if not isinstance(key, str):
        keys = list(key)
        packed = ranked_running_total(df.withColumn("__keys", F.struct(*keys)), "__keys", order, value,
                                      rank_col=rank_col, total_col=total_col, num_ranges=num_ranges)
        return packed.drop("__keys")
    spark = df.sparkSession
    n = num_ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    out_type = _total_type(df, value)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = write_once(
        df.repartitionByRange(n, F.col(key), *order_cols).withColumn(_PIECE, F.spark_partition_id()), "ranges")

    w = Window.partitionBy(key, _PIECE).orderBy(*order_cols)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (
        ranged.withColumn("__lrank", F.row_number().over(w))
        .withColumn("__lsum", F.sum(value).over(upto))
        .withColumn("__lnn", F.count(value).over(upto))  # non-null values so far (SQL: null sum if none)
    )

    # one row per range: its first key, and its last key with that key's local count and sum
    sort_key = [F.col(key).alias("k")] + [c.alias(f"o{i}") for i, c in enumerate(order_cols)]
    summary = local.groupBy(_PIECE).agg(
        F.min(F.struct(*sort_key)).getField("k").alias("first_key"),
        F.max(F.struct(*sort_key, F.col("__lrank").alias("cnt"), F.col("__lsum").alias("sm"),
                       F.col("__lnn").alias("nn"))).alias("last"),
    ).select(
        _PIECE, "first_key",
        F.col("last.k").alias("last_key"), F.col("last.cnt").alias("last_cnt"),
        F.col("last.sm").alias("last_sum"), F.col("last.nn").alias("last_nn"),
    )
    # rows of a key in earlier ranges = running totals of "last key" pieces of that key
    by_last = Window.partitionBy("last_key").orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, 0)
    ranges = Window.orderBy(_PIECE)  # at most one row per range: a single task is fine
    offsets = (
        summary.withColumn("cum_cnt", F.sum("last_cnt").over(by_last))
        .withColumn("cum_sum", F.sum("last_sum").over(by_last))
        .withColumn("cum_nn", F.sum("last_nn").over(by_last))
        .withColumn("prev_last", F.lag("last_key").over(ranges))
        .withColumn("prev_cnt", F.lag("cum_cnt").over(ranges))
        .withColumn("prev_sum", F.lag("cum_sum").over(ranges))
        .withColumn("prev_nn", F.lag("cum_nn").over(ranges))
        .withColumn("prev_piece", F.lag(_PIECE).over(ranges))
        .where(F.col("prev_piece").isNotNull() & F.col("prev_last").eqNullSafe(F.col("first_key")))
        .select(F.col(_PIECE).alias("__opiece"), F.col("first_key").alias("__okey"),
                F.col("prev_cnt").alias("__n0"), F.col("prev_sum").cast(out_type).alias("__s0"),
                F.col("prev_nn").alias("__nn0"))
    )
    on = (F.col(_PIECE) == F.col("__opiece")) & F.col(key).eqNullSafe(F.col("__okey"))
    return (
        local.join(F.broadcast(offsets), on, "left")
        .withColumn(rank_col, (F.col("__lrank") + F.coalesce(F.col("__n0"), F.lit(0))).cast("bigint"))
        .withColumn(total_col, F.when(
            F.col("__lnn") + F.coalesce(F.col("__nn0"), F.lit(0)) == 0, F.lit(None).cast(out_type)
        ).otherwise(
            (F.coalesce(F.col("__lsum").cast(out_type), F.lit(0).cast(out_type))
             + F.coalesce(F.col("__s0"), F.lit(0).cast(out_type))).cast(out_type)))
        .drop(_PIECE, "__opiece", "__okey", "__lrank", "__lsum", "__lnn", "__n0", "__s0", "__nn0")
    )
