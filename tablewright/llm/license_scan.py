"""License notices by diagonal voting (DataFrame only).

Templates are word sequences.  Every place of a text gives the hash of its
next ``K`` words, and a join with the hashes of the templates' places (a few
hundred rows, known before the job, hence broadcast) turns a text into hits
(text place, template, template place).  A notice that stands word for word
puts all its hits on one diagonal, text place minus template place; an
inserted or a missing word moves the rest to a neighbouring diagonal.  Votes
are counted per diagonal, neighbouring diagonals within ``SLACK`` of the one
before are merged into a span, and a span is verified by the words carried
with the hits: distinct template places it covers, weighed against all.

The first aggregate runs within the task that reads a text, so only hits
and one row per text are shuffled; they are written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import keep_table, read_table
from tablewright.llm.exact_dedup import ascii_lower

K = 3
SLACK = 3
MIN_COVER = 0.6
#: What separates words: ASCII but for letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases, found word for word, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices that may be quoted with small changes, and their labels.
NOTICES = {
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license": "gpl",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under the creative commons attribution 4 0 international license": "cc-by",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "all rights reserved": "all-rights-reserved",
}


def templates() -> list[tuple[int, str, list[str], bool]]:
    """(number, label, words, base)."""
    listed = [(label, text.split(), True) for text, label in PHRASES.items()]
    listed += [(label, text.split(), False) for text, label in NOTICES.items()]
    return [(i, label, words, base) for i, (label, words, base) in enumerate(listed)]


def _template_places(spark: SparkSession) -> DataFrame:
    """One row per template place: its K words and their hash."""
    rows = [(i, label, base, len(words) - K + 1, p, *words[p : p + K])
            for i, label, words, base in templates() for p in range(len(words) - K + 1)]
    names = ", ".join(f"t{j} string" for j in range(K))
    df = spark.createDataFrame(rows, f"template int, label string, base boolean, places int, place int, {names}")
    return df.withColumn("gram", F.xxhash64(*(f"t{j}" for j in range(K))))


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def scan_licenses(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  min_cover: float = MIN_COVER) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``n_words``, ``n_base``,
    ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` and
    ``spans`` (label, start, words covered, share of the template).

    A null text counts as empty; texts without words have zero counts, null
    places, empty labels and score 0; repeated rows come out as often as they
    came in; a null id stays null; other columns are ignored.  ``score`` is 1
    with a base phrase, else the largest share of a template that a span
    covers, of at least ``min_cover``, else 0.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = df.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                      words_of(text).alias("words")).withColumn("n_words", F.size("words").cast("long"))
    # the words themselves are not carried along with each place: only the ids and the number are
    grams = words.select(
        "id", "row", "n_words",
        F.posexplode_outer(F.transform("words", lambda w, i: F.struct(
            F.xxhash64(w, *(F.get("words", i + j) for j in range(1, K))).alias("gram"),
            w.alias("w0"), *(F.get("words", i + j).alias(f"w{j}") for j in range(1, K))))).alias("at", "g"))
    grams = grams.select("id", "row", "n_words", "at", "g.*")
    places = F.broadcast(_template_places(spark))
    same = grams.gram == places.gram
    for j in range(K):
        same = same & (grams[f"w{j}"] == places[f"t{j}"])
    votes = (
        grams.join(places, same, "left")
        .groupBy("id", "row", "n_words", "template", "label", "base", "places",
                 (F.col("at") - F.col("place")).cast("long").alias("diagonal"))
        .agg(F.collect_set("place").alias("covered"), F.min("place").alias("low"))
    )
    votes = keep_table(votes, "votes")  # read twice below; a row's number is thereby a fact
    # merge neighbouring diagonals of a template; base phrases stand on one diagonal alone
    side = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(side) > SLACK
    spans = (
        votes.where(F.col("template").isNotNull())
        .withColumn("new", F.coalesce(far | F.col("base"), F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(side))
        .groupBy("id", "row", "n_words", "template", "label", "base", "places", "span")
        .agg(F.min(F.col("diagonal") + F.col("low")).alias("start"), F.min("diagonal").alias("diagonal"),
             F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).cast("long").alias("hits"))
        .withColumn("share", F.least(F.col("hits") / F.col("places"), F.lit(1.0)))
        .where(F.when(F.col("base"), F.col("hits") == F.col("places")).otherwise(F.col("share") >= min_cover))
    )
    rows = votes.where(F.col("template").isNull()).select(
        "id", "row", "n_words", F.lit(None).cast("string").alias("label"), F.lit(False).alias("base"),
        F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("hits"),
        F.lit(None).cast("double").alias("share"))
    found = rows.unionByName(spans.select("id", "row", "n_words", "label", "base", "start", "hits", "share"))
    base = F.col("base")

    def joined(c: Column) -> Column:
        return F.concat_ws(",", F.array_sort(F.collect_set(c)))

    return (
        found.groupBy("id", "row", "n_words")
        .agg(F.count_if(base).alias("n_base"),
             F.min(F.when(base, F.col("start"))).alias("first_word"),
             F.max(F.when(base, F.col("start"))).alias("last_word"),
             joined(F.when(base, F.col("label"))).alias("base_labels"),
             joined(F.col("label")).alias("labels"),
             F.coalesce(F.max(F.when(base, F.lit(1.0)).otherwise(F.col("share"))), F.lit(0.0)).alias("score"),
             F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(),
                                                F.struct("start", "label", "hits", "share")))).alias("spans"))
        .select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                "score", "spans")
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


def _sql() -> str:
    values = ", ".join(f"({i}, '{label}', {base}, {len(words) - K + 1}, {p}, '{' '.join(words[p:p + K])}')"
                       for i, label, words, base in templates() for p in range(len(words) - K + 1))
    return f"""
WITH places(template, label, base, places, place, gram) AS (VALUES {values}),
d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{SEPARATORS}'), lambda w: w <> '') AS words FROM documents),
g AS (
  SELECT doc_id, words, unnest(range(len(words) - {K - 1})) AS pos FROM d),
hits AS (
  SELECT doc_id, template, label, base, places, place, pos - place AS diagonal
  FROM (SELECT doc_id, pos, words[pos + 1] || ' ' || words[pos + 2] || ' ' || words[pos + 3] AS gram FROM g) g
  JOIN places USING (gram)),
votes AS (
  SELECT doc_id, template, label, base, places, diagonal, list(DISTINCT place) AS covered, min(place) AS low
  FROM hits GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN base OR coalesce(diagonal - lag(diagonal) OVER w > {SLACK}, true) THEN 1 ELSE 0 END AS new
  FROM votes WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)),
spans AS (
  SELECT doc_id, template, label, base, places, span, min(diagonal + low) AS start,
    len(list_distinct(flatten(list(covered)))) AS hits
  FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM marked)
  GROUP BY ALL),
kept AS (
  SELECT *, least(hits / places, 1.0) AS share FROM spans
  WHERE CASE WHEN base THEN hits = places ELSE least(hits / places, 1.0) >= {MIN_COVER} END),
found AS (
  SELECT doc_id, count_if(base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels,
    max(CASE WHEN base THEN 1.0 ELSE share END) AS score
  FROM kept GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN found USING (doc_id)
"""


OP4_SQL = _sql()
