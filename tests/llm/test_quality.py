import time

import numpy as np
import pytest

from tablewright.llm import quality
from tablewright.llm.common import read_table
from tests.llm.conftest import TEXTS


def test_marginals_against_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    counts = np.array([3, 1, 4])
    first = np.concatenate([[0], np.cumsum(counts)])
    unary, trans = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    got, pairs, log_z = quality.marginals(unary, trans, counts, first)
    want, want_pairs, want_z = np.zeros((8, 2)), np.zeros((2, 2)), 0.0
    for k, n in enumerate(counts):
        total, part, pair = 0.0, np.zeros((n, 2)), np.zeros((2, 2))
        for labels in product((0, 1), repeat=int(n)):
            s = sum(unary[first[k] + i, y] for i, y in enumerate(labels))
            s = np.exp(s + sum(trans[a, b] for a, b in zip(labels, labels[1:])))
            total += s
            for i, y in enumerate(labels):
                part[i, y] += s
            for a, b in zip(labels, labels[1:]):
                pair[a, b] += s
        want[first[k] : first[k + 1]] = part / total
        want_pairs += pair / total
        want_z += np.log(total)
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def some():
    good = [f"The {w} ran over the hill and saw the sea.\nIt was a long {w} day." for w in
            ("dog cat fox hen cow pig owl bat rat ant".split() * 6)]
    bad = [f"BUY!!! {w.upper()}!! NOW!!\n$$$ ### {w} {w} {w} {w}\n%%% &&& ***" for w in
           ("dog cat fox hen cow pig owl bat rat ant".split() * 3)]
    return good + bad, [1] * len(good) + [0] * len(bad)


def test_scores_do_not_depend_on_the_company():
    model = quality.fit(*some())
    texts = [t or "" for _, t in TEXTS] + some()[0][::7]
    together = quality.scores(model, texts)
    alone = np.concatenate([quality.scores(model, [t]) for t in texts])
    assert np.allclose(together, alone) and ((0 <= together) & (together <= 1)).all()
    assert len(quality.scores(model, [])) == 0


def test_labels_are_learned():
    texts, labels = some()
    model = quality.fit(texts, labels)
    assert np.mean((quality.scores(model, texts) >= 0.3) == np.array(labels)) == 1
    assert quality.fit(["a"], [1]) == {"constant": 1.0} and quality.fit([], []) == {"constant": 0.5}


def test_edge_rows(edge_docs, no_docs):
    model = quality.fit(*some())
    assert len(quality.score_quality(edge_docs, model).collect()) == len(TEXTS)
    assert quality.score_quality(no_docs, model).collect() == []
    kept = quality.keep_good(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() <= len(TEXTS)


def test_held_out_accuracy(spark):
    rows = quality.op10_quality(spark, "/root/testdata/sf0.01").join(
        read_table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.9
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    held = {r.text for r in docs.join(labels, "doc_id").where(quality.fold(5, 0)).collect()}
    free = {r.text for r in docs.join(labels, "doc_id").where(~quality.fold(5, 0)).collect()}
    sample = quality.training_sample(docs, labels, "quality", 5, 0, max_docs=50)
    assert 0 < len(sample) <= 50 and not {t for t, _ in sample} & (held - free)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 100])
def test_pieces_of_texts_give_the_marginals_of_the_whole(chunk):
    rng = np.random.default_rng(chunk)
    counts = rng.integers(1, 30, 40)
    first = np.concatenate([[0], np.cumsum(counts)])
    unary = rng.normal(size=(counts.sum(), 2)) * 3
    trans = rng.normal(size=(2, 2)) * 2
    assert np.allclose(quality.line_marginals(unary, trans, counts, first, chunk),
                       quality.marginals(unary, trans, counts, first)[0])
    assert quality.line_marginals(np.empty((0, 2)), trans, np.empty(0, int), np.zeros(1, int)).shape == (0, 2)


def test_many_short_lines_are_scored_in_time():
    model = quality.fit(["A good line of words, as it should be.\n" * 3, "$$$ !!! 111\n" * 3] * 20, [1, 0] * 20)
    start = time.process_time()
    assert len(quality.scores(model, ["ab\n" * 200_000, "ok"])) == 2
    assert time.process_time() - start < 10  # one by one they took 0.1 ms each: 20 s


def test_long_texts_are_in_the_sample(spark):
    docs = spark.createDataFrame([(i, "x" * 60_000 if i % 2 else None) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    sample = quality.training_sample(docs, labels, "quality", 5, 0)
    assert sorted({len(t) for t, _ in sample}) == [0, 60_000] and all((len(t) > 0) == y for t, y in sample)
    few = quality.training_sample(docs, labels, "quality", 5, 0, max_bytes=200_000)
    assert few == sample[: len(few)] and 3 == sum(y for _, y in few)
