"""The corpus pipeline: five stages over ``documents``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns they got:

1. quality: the line CRF scores each text; rejected documents go.
2. exact_dedup: of equal texts (A-Z in either case) the one with the largest
   ``doc_id`` stays.
3. near_dedup: of each class of near duplicates one document stays, the one
   with the smallest ``doc_id``.
4. secrets: found secrets are masked in the text; ``n_chars`` follows.
5. packing: the texts become sequences of at most 4096 tokens; the pieces.

Null texts count as empty, repeated rows (same id and text) count as copies,
and an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.bpe import tokenizer_path
from tablewright.llm.common import keep_table, read_table
from tablewright.llm.exact_dedup import exact_dedup
from tablewright.llm.minhash import near_duplicates
from tablewright.llm.packing import pack_windows
from tablewright.llm.quality import fit_quality, keep_good
from tablewright.llm.secret_scan import mask_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score 0.3 or more.  Repeated rows go or stay
    together, a null text is scored as empty, an empty table stays empty."""
    return keep_good(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id and text digest are in ``kept``, once each.

    The small side is the hash table; rows are spread by id and digest, so
    neither copies nor a frequent id meet in one task."""
    columns = docs.columns
    rows = docs.withColumn("__key", F.md5(F.coalesce("text", F.lit(""))))
    names = kept.select(F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__none"),
                        F.col("key").alias("__key")).distinct()
    rows = rows.withColumns({"__id": F.coalesce("doc_id", F.lit(0)), "__none": F.col("doc_id").isNull()})
    on = ["__id", "__none", "__key"]
    return rows.join(names.hint("shuffle_hash"), on, "left_semi").dropDuplicates(on).select(*columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text (A-Z in either case): that of the largest id; a
    null id stays only where no other has the text.  Other columns play no part."""
    return _only(docs, exact_dedup(docs).where("kept").withColumnRenamed("text_md5", "key"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates: that of the smallest id
    (nulls last, then by text); rows that repeat id and text count once."""
    return _only(docs, near_duplicates(docs).where("kept").withColumn("key", F.lower(F.hex("key"))))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars``, where there is one, follows
    the text (null for a null text)."""
    masked = mask_secrets(docs, tokenizer_path("byte_bpe_50k.tiktoken"))
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts, a null text being one end mark; repeated rows
    are packed as often as they come."""
    return pack_windows(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL cannot express the classifier, the signatures or the token test.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
