"""Periodic runs of words by online dyadic square catching.

Words are appended to a text and numbered.  For every power of two m, a
block of m words that starts at a multiple of m gets a *catcher* when it is
complete.  A catcher waits for its block's words to come again 2m to 4m - 1
words later: a square of half-length p, 2m <= p < 4m, repeats some whole
block of m words at distance p, so one of its catchers sees it.  Each
appended word ends one suffix of m words per m, and just two blocks lie at
the right distance from it; so a word costs two comparisons per m, of
fingerprints that are doubled from m to 2m.  (Half-lengths 1, 2 and 3 are
caught with m = 1, half-length 1 at distance 1.)

What a catcher reports is a block that recurs at distance p.  Reports of
neighbouring blocks at the same distance are one stretch; suffix comparisons
with the shorter fingerprints extend its two ends by less than m words each.
A stretch of p or more words that recur at distance p is a square, and with
the p words behind it a maximal repetition.  Squares of several lengths that
cover the same words merge into one run: its period is the least of them.

All catchers of one m work on one array, so appending is a few array
operations per m: ``SquareCatcher.append`` takes any number of words, one
or a whole slice of texts (a mark that occurs nowhere else stands between
two texts, and nothing recurs across it).

Fingerprints have 64 bits; every run is compared word by word in the end.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import map_texts, read_table, text_or_empty
from tablewright.llm.minhash import mix

MIN_LENGTH = 12
_U = np.uint64


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[i]``, ``first[i] + 1``, ... (``size[i]`` numbers), one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


class SquareCatcher:
    """Squares of half-length up to ``longest`` in words appended bit by bit."""

    def __init__(self, longest: int):
        self.n = 0
        self.levels = [1]
        while 2 * 2 * self.levels[-1] <= longest:
            self.levels.append(2 * self.levels[-1])
        self.prints: list[np.ndarray] = [np.empty(0, _U) for _ in self.levels]
        #: Per level: blocks (first word) and distances at which they recur.
        self.seen: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in self.levels]

    def append(self, words: np.ndarray) -> None:
        """``words``: an integer per word."""
        self.n += len(words)
        fresh = mix(words.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(1))
        for k, m in enumerate(self.levels):
            old = len(self.prints[k])
            if k:
                half, below = m // 2, self.prints[k - 1]
                left, right = below[old : max(len(below) - half, old)], below[old + half :]
                with np.errstate(over="ignore"):
                    fresh = mix(left * _U(0xD1342543DE82EF95) + right)
            got = self.prints[k] = np.concatenate([self.prints[k], fresh])
            at = np.arange(old, len(got))  # where suffixes of m words that ended now begin
            for back in (2, 3):
                block = (at // m - back) * m
                inside = np.searchsorted(block, 0)  # blocks grow with ``at``
                x, block = at[inside:], block[inside:]
                hit = np.flatnonzero(got[x] == got[block])
                self.seen[k].append((block[hit], x[hit] - block[hit]))
            if k == 0:
                x = at[1:] if old == 0 else at
                hit = np.flatnonzero(got[x] == got[x - 1])
                self.seen[k].append((x[hit] - 1, np.ones(len(hit), np.int64)))

    def _same(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Do the words from ``a`` and from ``b``, 2**level of them, agree?
        Places outside the text agree with nothing."""
        got = self.prints[level]
        ok = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(got))
        ok[ok] = got[a[ok]] == got[b[ok]]
        return ok

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and periods of the maximal repetitions seen so far, by start and period."""
        start, end, period = [], [], []
        for k, m in enumerate(self.levels):
            block = np.concatenate([b for b, _ in self.seen[k]] or [np.empty(0, np.int64)])
            p = np.concatenate([d for _, d in self.seen[k]] or [np.empty(0, np.int64)])
            if not len(block):
                continue
            order = np.lexsort((block, p))
            block, p = block[order], p[order]
            new = np.r_[True, (p[1:] != p[:-1]) | (block[1:] != block[:-1] + m)]
            first = np.flatnonzero(new)
            lo, p = block[first], p[first]
            hi = block[np.r_[first[1:], len(block)] - 1] + m
            for level in range(k - 1, -1, -1):  # fewer than m words on either side
                step = 1 << level
                lo = lo - step * self._same(level, lo - step, lo - step + p)
                hi = hi + step * self._same(level, hi, hi + p)
            square = hi - lo >= p
            start.append(lo[square])
            end.append(hi[square] + p[square])
            period.append(p[square])
        s, e, q = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (start, end, period))
        order = np.lexsort((q, e, s))
        s, e, q = s[order], e[order], q[order]
        least = np.r_[True, (s[1:] != s[:-1]) | (e[1:] != e[:-1])] if len(s) else np.empty(0, bool)
        s, e, q = s[least], e[least], q[least]
        order = np.lexsort((q, s))
        return s[order], e[order], q[order]


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' words as numbers, a mark of its own after each text, and where each text begins."""
    number: dict[bytes, int] = {}
    take = number.setdefault
    ids, first = [], [0]
    for i, words in enumerate(texts):
        ids += [take(w, len(number)) for w in words]
        ids.append(-1 - i)
        first.append(len(ids))
    return np.array(ids, np.int64), np.array(first, np.int64)


def find_runs(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per text: starts, lengths and periods of its runs, by start and period."""
    ids, first = word_numbers(texts)
    catcher = SquareCatcher(max(map(len, texts), default=0) // 2)
    catcher.append(ids)
    s, e, q = catcher.runs()
    long = e - s >= np.maximum(min_length, 2 * q)
    s, e, q = s[long], e[long], q[long]
    # word by word: place x of a run equals place x - q
    x = _ranges(s + q, e - s - q)
    wrong = np.repeat(np.arange(len(s)), e - s - q)[ids[x] != ids[x - np.repeat(q, e - s - q)]]
    if len(wrong):
        raise ArithmeticError("two stretches of words share a fingerprint")
    of = np.searchsorted(first, s, side="right") - 1
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    return [(s[a:b] - first[i], (e - s)[a:b], q[a:b]) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:]))]


def collapse(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words joined by one space, each run cut down to its first period."""
    if not len(start):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)])


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def periodic_runs(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  words_of: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``n_words``, ``runs`` (by start,
    then period) and ``collapsed``, the text with each run cut down to its
    first period and words joined by one space.

    Words are what stands between ASCII white space.  A run is a stretch with
    least period q and at least ``max(min_length, 2 q)`` words that no
    neighbouring word extends.  ``words_of(id, words)`` may replace a text's
    words.  A null or empty text has no words and no runs; repeated rows come
    out as often as they came in; a null id stays null; other columns are
    dropped; an empty table gives no rows.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col))

    def work():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column(0).to_pylist()
            texts = [t.split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            if words_of is not None:
                texts = [words_of(i, w) for i, w in zip(ids, texts)]
            found = find_runs(texts, min_length)
            ends = np.cumsum([0, *(len(f[0]) for f in found)], dtype=np.int32)
            flat = [np.concatenate([f[k] for f in found]) for k in range(3)]
            runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in flat], names=["start", "length", "period"])
            text = pa.array([collapse(w, *f) for w, f in zip(texts, found)], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.ListArray.from_arrays(ends, runs), text],
                names=[id_col, "n_words", "runs", "collapsed"])
        return run

    return map_texts(src, f"{id_col} long, n_words long, runs array<{RUN}>, collapsed string", work)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words the query's contract puts in place of a document's own: every
    tenth document (by CRC-32 of its id) becomes periodic from word a on.  A
    null id plants nothing."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(b"%d" % doc_id), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's longest run and digests of all runs and of the collapsed text."""
    found = periodic_runs(read_table(spark, sf_dir, "documents"), words_of=planted)
    longest = F.reduce("runs", F.lit(None).cast(RUN), lambda best, r: F.when(
        best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
