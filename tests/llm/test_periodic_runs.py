"""Runs of words against brute force, whole and appended word by word."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm.common import read_table
from tablewright.llm.periodic_runs import SquareCatcher, collapse, find_runs, op12_periodic_runs, periodic_runs, planted
from tests.conftest import SF0001
from tests.llm.conftest import LONG, TEXTS


def brute_runs(words, min_length=12):
    """Every (start, length, least period) by definition: stretches that recur at distance q, per q."""
    names, best = {}, {}
    at = np.array([names.setdefault(w, len(names)) for w in words])
    for q in range(len(at) // 2, 0, -1):
        same = np.r_[False, at[:-q] == at[q:], False]
        for i, j in np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2).tolist():
            if j - i >= q:
                best[i, j + q] = q  # smaller periods come later
    return sorted((s, e - s, q) for (s, e), q in best.items() if e - s >= max(min_length, 2 * q))


def brute_row(doc_id, text):
    words = [w for w in text.encode().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\v", b" ")
             .replace(b"\f", b" ").replace(b"\r", b" ").split(b" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs)).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def as_lists(found):
    return [list(zip(*(x.tolist() for x in f))) for f in found]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=4))
def test_runs_equal_brute_force(texts):
    words = [[b"%d" % w for w in t] for t in texts]
    assert as_lists(find_runs(words, 2)) == [brute_runs(w, 2) for w in words]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.integers(1, 12), st.integers(0, 60), st.integers(0, 9))
def test_planted_periods(before, p, n, extra):
    body = list(range(10, 10 + p))
    words = [b"%d" % w for w in before + (body * (n // p + 1))[:n] + body[:1] * extra]
    assert as_lists(find_runs([words], 2)) == [brute_runs(words, 2)]


def test_appending_word_by_word_gives_the_same():
    rng = np.random.default_rng(5)
    for _ in range(20):
        words = np.concatenate([rng.integers(0, 3, rng.integers(0, 40)), np.tile(rng.integers(0, 9, 7), 5)])
        whole, steps, parts = (SquareCatcher(len(words) // 2) for _ in range(3))
        whole.append(words)
        for w in words:
            steps.append(np.array([w]))
        for part in np.array_split(words, 4):
            parts.append(part)
        want = [x.tolist() for x in whole.runs()]
        assert [x.tolist() for x in steps.runs()] == want == [x.tolist() for x in parts.runs()]


def test_squares_are_reported_as_words_come():
    catcher = SquareCatcher(8)
    seen = []
    for w in [1, 2, 3, 4, 1, 2, 3, 4, 5]:
        catcher.append(np.array([w]))
        seen.append(len(catcher.runs()[0]))
    assert seen == [0] * 7 + [1, 1]


def test_long_texts():
    words = LONG.encode().split()
    assert as_lists(find_runs([words])) == [[(0, len(words), 9)]]
    assert collapse(words, *find_runs([words])[0]) == b"the quick brown fox jumps over the lazy dog"
    same = [b"a"] * 300_000
    assert as_lists(find_runs([same])) == [[(0, 300_000, 1)]]
    far = [b"%d" % i for i in range(100_000)]
    assert as_lists(find_runs([far + far])) == [[(0, 200_000, 100_000)]]


def test_edges(spark, edge_docs, no_docs):
    assert periodic_runs(no_docs).collect() == []
    got = periodic_runs(edge_docs).collect()
    assert len(got) == len(TEXTS) and edge_docs.count() == len(TEXTS)
    by = {r.doc_id: r for r in got if r.doc_id != 1}
    assert (by[2].n_words, by[2].runs, by[2].collapsed) == (0, [], "") == (by[3].n_words, by[3].runs, by[3].collapsed)
    assert (by[4].n_words, by[4].collapsed) == (0, "")
    assert by[None].collapsed == "no id here" and by[9].n_words == 3  # \x1c does not part words
    assert [tuple(r) for r in by[7].runs] == [(0, 180_000, 9)]
    assert sum(r.doc_id == 1 for r in got) == 2
    assert planted(None, [b"a"]) == [b"a"]


@pytest.mark.parametrize("repeat", ["a b c a b c a b c a b c", "x " * 11, "x " * 12, "a b c d e f " * 2, "a b a b " * 3])
def test_minimum_lengths(spark, repeat):
    row = periodic_runs(spark.createDataFrame([(1, repeat)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == brute_runs(repeat.split())


def test_query(spark):
    rows = {r.doc_id: r.text or "" for r in read_table(spark, SF0001, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: tuple(r) for r in op12_periodic_runs(spark, SF0001).collect()}
    assert got == {i: brute_row(i, t) for i, t in rows.items()}
    assert len(got) == len(rows) and any(r[1] for r in got.values())
