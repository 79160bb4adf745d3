"""Exact duplicates by a tree merge of sorted digest runs (DataFrame only).

Every input partition is a run: its rows' digests, sorted, one entry per
digest with the identifier to keep, the number of rows and a second digest.
Runs are merged in rounds; in a round, ``fan_in`` neighbouring runs become
one, and entries with the same digest become one entry that keeps the better
identifier and the sum of the counts.  An entry is verified wherever entries
meet: rows that agree in SHA-256 must agree in length and in a second,
unrelated hash too, or the job fails.  The exchange of a round is on (merged
run, digest): a run is spread over tasks by digest, no task holds a whole run.

The answer then goes back down the same tree: each entry of a round joins
the merged entry it went into.  An entry meets at most ``fan_in`` entries of
the round below, so a text that makes up a third of all rows never gathers
in one task: it is one entry per run, and within its own run its rows are
read where they lie.

Runs and rounds are written to the shared folder: the run number of a row is
thereby a fact, and a lost executor repeats one round only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import keep_table, read_table

FAN_IN = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Whatever is not ASCII, nor of blocks that hold no capitals (Latin-1 marks and small letters, dashes and quotes, Han).
MAYBE_CAPITALS = r"[^\x00-\x7F\u00A0-\u00BF\u00DF-\u00FF\u2010-\u2027\u4E00-\u9FA5]"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed.

    ``lower`` does just that, and much faster than ``translate``, wherever no
    other capital can occur.
    """
    return F.when(text.rlike(MAYBE_CAPITALS), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def exact_dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
                fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256``, ``text_md5`` (of the text as it is).

    Texts are equal when identical after lower-casing A-Z; a null text counts
    as empty.  The row with the largest (``keep="min"``: smallest) identifier
    stays; of rows that repeat the identifier as well, the first read.  A null
    identifier ranks below (``min``: above) every other.  Other columns are
    ignored; an empty table gives no rows.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep is 'max' or 'min'")
    norm = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    best = F.max if keep == "max" else F.min
    sign = 1 if keep == "max" else -1
    rows = (
        df.select(F.col(id_col).cast("long").alias("id"), norm.alias("norm"),
                  F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_md5"))
        .select("id", "text_md5", F.unhex(F.sha2("norm", 256)).alias("digest"),
                F.struct(F.length("norm").alias("n"), F.xxhash64("norm").alias("h")).alias("check"),
                F.spark_partition_id().cast("long").alias("run"),
                F.monotonically_increasing_id().alias("row"))
    )
    rows = keep_table(rows.sortWithinPartitions("digest"), "digest-runs")

    def verified(c: str) -> Column:
        return F.when(F.min(c) == F.max(c), F.min(c)).otherwise(
            F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("struct<n:int,h:bigint>")).alias("check")

    # earlier rows first among equal identifiers; a null identifier never stays if another is there
    rank = F.struct(F.col("id").isNotNull().cast("int") if keep == "max" else F.col("id").isNull().cast("int"),
                    "id", (F.lit(-sign) * F.col("row")).alias("row"))
    rounds = [rows.groupBy("run", "digest").agg(best(rank).alias("best"), F.count("*").alias("n"), verified("check"))]
    last = rows.agg(F.max("run")).first()[0] or 0
    while last:
        rounds[-1] = keep_table(rounds[-1], "digest-round")
        last //= fan_in
        rounds.append(
            rounds[-1].withColumn("run", F.floor(F.col("run") / fan_in))
            .groupBy("run", "digest").agg(best("best").alias("best"), F.sum("n").alias("n"), verified("check"))
        )
    answer = rounds.pop().select("run", "digest", "best", "n")
    for entries in reversed(rounds):
        below = entries.select(F.col("run").alias("own"), "digest", F.floor(F.col("run") / fan_in).alias("run"))
        answer = (below.join(answer, ["run", "digest"])
                  .select(F.col("own").alias("run"), "digest", "best", "n"))
    return rows.join(answer, ["run", "digest"]).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        (F.col("row") == F.lit(-sign) * F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "text_md5",
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for its text."""
    return exact_dedup(read_table(spark, sf_dir, "documents")).drop("text_md5")


OP5_SQL = f"""
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
