import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import ann
from tablewright.llm.common import read_table
from tests.conftest import SF001

ODD = [(0, [1.0, 0.0, 0.0]), (50, [1.0, 0.1, 0.0]), (51, None), (52, [0.0, 0.0, 0.0]), (53, [float("nan"), 1.0, 0.0]),
       (54, [float("inf"), 1.0, 0.0]), (55, [None, 1.0, 0.0]), (56, []), (57, [2.0, 0.0, 0.0]), (58, [3.0, 0.0, 0.0]),
       (59, [-1.0, 0.0, 0.0]), (60, [1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (57, [2.0, 0.0, 0.0]), (100, [0.0, 1.0])]


def brute(rows, k):
    fine = {i: np.array(v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q, v in fine.items():
        if q % 50 == 0:
            s = sorted((-(v @ w) / (np.sqrt(v @ v) * np.sqrt(w @ w)), i) for i, w in fine.items()
                       if i != q and len(w) == len(v))
            out[q] = [i for _, i in s[:k]]
    return out


def test_odd_vectors(spark):
    df = spark.createDataFrame(ODD, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).repartition(3)
    got = ann.nearest_neighbours(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(by[r.query_id])
    assert by == brute(ODD, 5)
    none = ann.nearest_neighbours(df.where("false"), F.col("id") % 50 == 0)
    assert none.collect() == []


@pytest.mark.parametrize("kind", ["spread", "one point", "clusters"])
def test_recall_over_shards(spark, kind, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 32))
    if kind == "one point":
        x[: len(x) // 3] = x[0] + rng.normal(size=(500, 32)) * 0.01
    if kind == "clusters":
        x = rng.normal(size=(15, 32))[rng.integers(0, 15, len(x))] + x * 0.05
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    twins = ann.first_twins(vectors, 6)
    index = ann.build_index(twins.where("id = rep"), shard_rows=400)
    assert index.count() == 4
    got = {}
    for r in ann.nearest(index, vectors.where("id % 50 = 0"), twins, 5).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(rows, 5)
    assert np.mean([len(got[q] & set(n)) / 5 for q, n in want.items()]) >= 0.95


def test_equal_vectors_go_to_the_smaller_ids(spark):
    rows = [(i, [1.0, 2.0]) for i in range(600)]
    got = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                                 F.col("id").isin(0, 3, 599)).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3, 4, 5, 0, 1, 2, 4, 5, 0, 1, 2, 3, 4]


def cosines(rows):
    x = np.array([v for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def check_exact(spark, rows, asked, k=5):
    """As many rows as the contract asks for, with brute force's scores."""
    cos, ids = cosines(rows), np.array([i for i, _ in rows])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest_neighbours(df, F.col("id").isin(asked), k=k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for a in asked:
        at = int(np.flatnonzero(ids == a)[0])
        others = [j for j in np.lexsort((ids, -np.round(cos[at], 12))) if j != at][:k]
        assert np.allclose([s for _, s in got[a]], cos[at, others], atol=1e-12)
        yield a, [i for i, _ in got[a]], ids[others].tolist()


def test_parallel_vectors_give_the_smallest_ids(spark):
    rows = [(i, [2.0 ** (i % 200), 2.0 ** (i % 200 + 1)]) for i in range(500)]
    for _, got, want in check_exact(spark, rows, [0, 50, 499]):
        assert got == want
    rows = [(i, [1.0 + i, 2.0 + 2 * i, 3.0 + 3 * i]) for i in range(700)]
    for a, got, _ in check_exact(spark, rows, [0, 350, 699]):
        assert sorted(got) == [i for i in range(7) if i != a][:5]  # in the order of their rounding errors


def test_ties_among_different_vectors(spark):
    """One-hot vectors: all others at cosine 0; and two circles around a query."""
    rows = [(i, [float(j == i) for j in range(300)]) for i in range(300)]
    for _, got, want in check_exact(spark, rows, [0, 150, 299]):
        assert got == want
    rng = np.random.default_rng(2)
    angle = rng.uniform(0, 2 * np.pi, 3000)
    rows = [(0, [0.0, 0.0, 1.0])] + [(i + 1, [float(np.cos(a)), float(np.sin(a)), 1.0]) for i, a in enumerate(angle)]
    for _, got, _ in check_exact(spark, rows, [0]):
        assert got == [1, 2, 3, 4, 5]


def test_clusters_tied_in_single_precision(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4, 8))
    rows = [(i, (base[i % 4] + rng.normal(size=8) * 1e-9).tolist()) for i in range(2400)]
    for _, got, _ in check_exact(spark, rows, [0, 1, 2399]):
        assert len(got) == 5


def test_huge_and_tiny_vectors(spark):
    rows = [(i, [10.0 ** (150 - 3 * i), 10.0 ** (150 - 3 * i) * (1 + i)]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest_neighbours(df, F.col("id") == 50).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [51, 49, 52, 48, 53]


def test_query_reaches_brute_force(spark):
    """Recall by score on the given table."""
    rows = [(r.vec_id, [float(e) for e in r.embedding])
            for r in read_table(spark, SF001, "embeddings").collect()
            if r.embedding is not None and all(e is not None and np.isfinite(e) for e in r.embedding) and any(r.embedding)]
    cos, ids = cosines(rows), np.array([i for i, _ in rows])
    got = {}
    for r in ann.op6_neighbours(spark, SF001).collect():
        got.setdefault(r.query_id, []).append(r.score)
    hits = total = 0
    for at in np.flatnonzero(ids % 50 == 0):
        best = np.sort(np.delete(cos[at], at))[::-1][:5]
        assert len(got[ids[at]]) == 5
        hits += (np.sort(got[ids[at]])[::-1] >= best[-1] - 1e-12).sum()
        total += 5
    assert hits / total >= 0.9 and len(got) == (ids % 50 == 0).sum()
