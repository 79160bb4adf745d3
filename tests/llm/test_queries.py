"""Registered queries against their SQL, and the pipeline stage by stage."""

import hashlib

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from pyspark.sql import functions as F
from tablewright.llm import minhash, packing, quality
from tablewright.llm.bpe import Encoder, read_vocabulary, tokenizer_path
from tablewright.llm.common import read_table
from tablewright.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF0001
from tests.llm.conftest import TEXTS
from tests.llm.test_bpe_packing import check_packing
from tests.llm.test_dedup import brute_classes, lowered, partition
from tests.llm.test_scans import brute_secrets


def test_all_are_registered():
    assert [sum(q.startswith(f"op{n}_") for q in entry.queries()) for n in range(1, 14)] == [1] * 13
    assert set(ORACLE_SQL) <= set(QUERIES) <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "secrets", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, SF0001)
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    assert sorted(repr([r[c] for c in cols]) for r in df.collect()) == sorted(repr([r[i] for i in at]) for r in cur.fetchall())


def _rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_pipeline_stages_against_brute_force(spark):
    docs = read_table(spark, SF0001, "documents")
    good = corpus_pipeline.quality(spark, docs, SF0001)
    model = quality.fit_quality(docs, read_table(spark, SF0001, "labels"))
    score = dict(zip([d.doc_id for d in docs.collect()], quality.scores(model, [d.text or "" for d in docs.collect()])))
    assert good.columns == docs.columns
    assert _rows(good) == sorted(((d.doc_id, d.text) for d in docs.collect() if score[d.doc_id] >= 0.3), key=str)

    best = {}
    for i, t in _rows(good):
        best[lowered(t)] = max(i, best.get(lowered(t), i))
    own = corpus_pipeline.exact(spark, good, SF0001)
    assert own.columns == docs.columns
    assert _rows(own) == sorted(((i, t) for i, t in _rows(good) if best[lowered(t)] == i), key=str)

    rows = sorted(_rows(own))
    classes = brute_classes(rows)
    near = corpus_pipeline.near(spark, own, SF0001)
    assert _rows(near) == sorted((rows[i] for i in set(classes)), key=str)

    masked = corpus_pipeline.secrets(spark, near, SF0001)
    assert masked.dtypes == docs.dtypes
    for r in masked.collect():
        assert not brute_secrets(r.text) and r.n_chars == len(r.text)

    encoder = Encoder(read_vocabulary(tokenizer_path("word_bpe_49k.json")))
    want = [(r.doc_id, [*encoder.encode(r.text).tolist(), 2]) for r in masked.collect()]
    check_packing(corpus_pipeline.packing(spark, masked, SF0001).collect(), want, packing.WINDOW)
    check_packing(corpus_pipeline.run(spark, SF0001).collect(), want, packing.WINDOW)


def test_stages_take_edge_rows(spark):
    docs = spark.createDataFrame([(i, t, "en", None, None if t is None else len(t)) for i, t in TEXTS],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("key", F.lit("clash"))
    for rows in (docs, docs.where("false")):
        out = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SF0001)
            assert out.columns == docs.columns, name
        assert corpus_pipeline.packing(spark, out, SF0001).count() >= out.count()
    kept = corpus_pipeline.exact(spark, docs, SF0001).collect()
    assert len(kept) == len({lowered(t) for _, t in TEXTS})
    near = corpus_pipeline.near(spark, docs, SF0001).collect()
    assert len(near) == len(set(brute_classes(TEXTS)))


def test_one_near_copy_stays_of_null_or_repeated_ids(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(None, words), (None, words + " x"), (7, "a " + words.upper().replace("W", "v")),
            (7, words.replace("w", "v") + " y"), (8, words.replace("w", "v"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(set(brute_classes(rows))) == 2
    assert sorted(str(r.doc_id) for r in corpus_pipeline.near(spark, docs, SF0001).collect()) == ["7", "None"]


def _documents(spark):
    return {r.doc_id: r.text or "" for r in read_table(spark, SF0001, "documents").select("doc_id", "text").collect()}


def test_op1_query_equals_the_library(spark):
    texts = _documents(spark)
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids = {i: e.ids for i, e in zip(texts, tok.encode_batch(list(texts.values()), add_special_tokens=False))}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {i: (len(x), sha(" ".join(map(str, x))), sha(tok.decode(x, skip_special_tokens=False))) for i, x in ids.items()}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op1_bpe"](spark, SF0001).collect()} == want


def test_op2_query_packs_the_librarys_ids(spark):
    texts = _documents(spark)
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = [(i, [*e.ids, 2]) for i, e in zip(texts, tok.encode_batch(list(texts.values()), add_special_tokens=False))]
    rows = QUERIES["op2_pack"](spark, SF0001).collect()
    check_packing(rows, want, 4096)
    ends = {}
    for r in rows:
        ends[r.sequence_id] = max(ends.get(r.sequence_id, 0), r.offset + r.length)
    padding = sum(4096 - n for n in ends.values() if n & (n - 1))
    assert padding <= 0.02 * 4096 * len(ends)


def test_op3_query_equals_brute_force(spark):
    rows = list(_documents(spark).items())
    got = QUERIES["op3_near_duplicates"](spark, SF0001).collect()
    assert partition((r.doc_id, r.class_id) for r in got) == partition(
        (rows[i][0], c) for i, c in enumerate(brute_classes(rows)))


def test_op4_query_and_its_sql_agree_on_repeated_grams(spark, tmp_path):
    rows = [(1, "apache license version " * 4), (2, "licensed under the apache license version 2 0"), (3, None),
            (4, "this program is free software you can redistribute it and or modify it under the terms"),
            (5, "mit mit under the mit license mit under the mit license"), (6, "cc by nc cc by nc 4 0 cc by nc")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op4_licenses"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(ORACLE_SQL["op4_licenses"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
    assert got.where("doc_id = 1").first().labels == ""
