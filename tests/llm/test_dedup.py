import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tablewright.llm.common import read_table
from tablewright.llm.exact_dedup import LOWER, UPPER, ascii_lower, exact_dedup
from tablewright.llm.minhash import dart_minhash, mix, near_duplicates
from tests.conftest import SF0001
from tests.llm.conftest import TEXTS

from pyspark.sql import functions as F


def lowered(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def test_only_ascii_letters_are_lowered(spark):
    texts = ["ABC xyz", "ÉCOLE Σ", "İK", "Ⅷ Ⓐ ǅ", "straße É", "漢字 A", "Ꭰ Ა"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ascii_lower(F.col("t")).alias("l")).collect()
    assert {r.t: r.l for r in rows} == {t: lowered(t) for t in texts}


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("fan_in, parts", [(2, 9), (16, 3)])
def test_exact_against_brute_force(spark, keep, fan_in, parts):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "A", "b", "c" * 50, None, "", "É", "é"]) if i % 3 else "hot") for i in range(400)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), keep=keep,
                      fan_in=fan_in).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    best = max if keep == "max" else min
    want = {(i, best(groups[lowered(t)]), len(groups[lowered(t)]), i == best(groups[lowered(t)]),
             hashlib.sha256(lowered(t).encode()).hexdigest()) for i, t in rows}
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == want


def test_exact_edge_rows(spark, edge_docs, no_docs):
    rows = exact_dedup(edge_docs).collect()
    assert len(rows) == len(TEXTS)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text_sha256, []).append(r)
    assert all(sum(r.kept for r in g) == 1 for g in by_text.values())  # repeated rows too: one stays
    assert {r.keep_id for r in rows if r.doc_id in (2, 3)} == {3}
    assert {r.keep_id for r in rows if r.doc_id in (1, 5)} == {5}
    assert exact_dedup(no_docs).collect() == []


def test_null_id_stays_only_alone(spark):
    rows = exact_dedup(spark.createDataFrame([(None, "x"), (1, "x"), (None, "y")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in rows} == {(None, 1, False), (1, 1, True), (None, None, True)}


def weighted_jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)


@pytest.mark.parametrize("size", [3, 60, 3000])
def test_signatures_estimate_weighted_similarity(size):
    rng = np.random.default_rng(size)
    agree, want = [], []
    for trial in range(12):
        e = mix(np.arange(size, dtype=np.uint64) + np.uint64(trial * 100_000))
        a, b = rng.uniform(0, 6, size), rng.uniform(0, 6, size) * rng.integers(0, 2, size)
        b[0] = a[0]
        s = dart_minhash(np.concatenate([e, e]), np.concatenate([a, b]), np.repeat([0, 1], size), 2, 256)
        agree.append((s[0] == s[1]).mean())
        want.append(weighted_jaccard(dict(enumerate(a)), dict(enumerate(b))))
    assert abs(np.mean(agree) - np.mean(want)) < 0.04


def test_empty_sets_have_no_signature():
    s = dart_minhash(np.array([1], np.uint64), np.array([1.0]), np.array([1]), 3, 8)
    assert (s[[0, 2]] == np.uint64(0xFFFFFFFFFFFFFFFF)).all() and (s[1] < np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def shingle_sets(rows):
    out = []
    for _, text in rows:
        w = (text or "").lower().split()
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset())
    return out


def brute_classes(rows):
    """Class of every row: components of similarity 0.8 or more, or of equal texts."""
    sets, root = shingle_sets(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for g in s or {(rows[i][1] or "",)}:
            where.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s or {(rows[i][1] or "",)} for j in where[g] if j < i}:
            both = len(s & sets[j])
            if both >= 0.8 * (len(s) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


def partition(keys):
    groups = {}
    for item, key in keys:
        groups.setdefault(key, []).append(str(item))
    return sorted(sorted(g) for g in groups.values())


def chains():
    """Chains of texts whose neighbours alone are similar, a large group, and texts that share half."""
    rnd = random.Random(1)
    word = lambda: "w%d" % rnd.randint(0, 10**6)
    rows, base = [], [word() for _ in range(100)]
    for i in range(12):  # each differs from the one before by its edges
        rows.append((i, " ".join(base[i * 4 : i * 4 + 60])))
    group = [word() for _ in range(200)]
    for i in range(40):
        text = list(group)
        text[rnd.randint(0, 199)] = word()
        rows.append((100 + i, " ".join(text)))
    half = [word() for _ in range(60)]
    rows += [(200 + i, " ".join(half + [word() for _ in range(60)])) for i in range(30)]
    return rows


@pytest.mark.parametrize("rows", [chains(), TEXTS], ids=["chains", "edges"])
def test_near_against_brute_force(spark, rows):
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").withColumn("bands", F.lit(1))).collect()
    assert len(got) == len(rows)
    assert partition((r.doc_id, r.class_id) for r in got) == partition(
        (rows[i][0], c) for i, c in enumerate(brute_classes(rows)))


def sparse_family(n, kept):
    """Texts that each leave out some paragraphs of one template: most pairs at 0.7 to 0.79, few at 0.8."""
    rnd = random.Random(1)
    parts = [" ".join("p%dw%d" % (p, w) for w in range(12)) for p in range(60)]
    return [(i, " ".join(parts[p] for p in sorted(rnd.sample(range(60), kept)))) for i in range(n)]


def matrix_classes(rows):
    """As brute_classes, with the overlaps of all pairs from one matrix product."""
    sets, column = shingle_sets(rows), {}
    has = np.zeros((len(rows), len(set().union(*sets))), np.float32)
    for i, s in enumerate(sets):
        has[i, [column.setdefault(g, len(column)) for g in s]] = 1
    both, size = has @ has.T, has.sum(1)
    root = np.arange(len(rows))
    for i, j in np.argwhere(np.triu(both >= 0.8 * (size[:, None] + size - both), 1)):
        root[root == max(root[i], root[j])] = min(root[i], root[j])
    return root.tolist()


@pytest.mark.parametrize("kept", [51, 52])
def test_large_family_with_sparse_links(spark, kept):
    rows = sparse_family(1200, kept)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert partition((r.doc_id, r.class_id) for r in got) == partition(
        (rows[i][0], c) for i, c in enumerate(matrix_classes(rows)))


def test_family_with_a_star_of_half_its_rows(spark):
    """Half of the texts link to one centre, the others to it or to each other here and there."""
    rnd = random.Random(4)
    base = ["b%d" % i for i in range(300)]

    def edited(n):
        text = list(base)
        for _ in range(n):
            text[rnd.randrange(300)] = "e%d" % rnd.randrange(10**9)
        return " ".join(text)

    rows = [(i, edited(rnd.choice([1, 2]) if i % 2 else rnd.randrange(3, 25))) for i in range(900)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert partition((r.doc_id, r.class_id) for r in got) == partition(
        (rows[i][0], c) for i, c in enumerate(matrix_classes(rows)))


def test_near_on_given_documents(spark):
    docs = read_table(spark, SF0001, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_duplicates(docs).collect()
    assert partition((r.doc_id, r.class_id) for r in got) == partition(
        (rows[i][0], c) for i, c in enumerate(brute_classes(rows)))
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_near_of_nothing(no_docs):
    assert near_duplicates(no_docs).collect() == []


def test_every_code_point(spark):
    """A-Z become a-z, whatever stands beside them; nothing else changes."""
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"A{chr(c)}b" for c in points]
    df = spark.createDataFrame(pa.table({"t": texts})).select("t", ascii_lower(F.col("t")).alias("l"))
    wrong = df.where(F.col("l") != F.translate("t", UPPER, LOWER))
    assert df.count() == len(texts) and wrong.isEmpty()


def test_letters_of_newer_unicode_versions_stay_apart(spark):
    docs = spark.createDataFrame([(1, "Ⱟ x"), (2, "ⱟ x"), (3, "ⱟ X")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()}
    assert got == {1: (1, 1, True), 2: (3, 2, False), 3: (3, 2, True)}


def test_a_node_brings_its_buckets_to_its_block_in_one_row(spark):
    from tablewright.llm.minhash import _blocks
    rows = [(b, b"c", bytes([n]), bytes([n])) for n in range(20) for b in range(n % 4 + 1)]
    mixed = spark.createDataFrame(rows, "bucket long, centre binary, node binary, root binary")
    sizes = mixed.select("node").distinct().withColumn("size", F.lit(3))
    got = {bytes(r.node): sorted(r.buckets) for r in _blocks(mixed, sizes).collect()}
    assert got == {bytes([n]): list(range(n % 4 + 1)) for n in range(20)}
    assert _blocks(mixed, sizes).count() == 20
