"""Spelling variants by bidirectional FM-index search schemes.

Vocabulary.  Runs of letters are counted per document, per task and then per
word, so a frequent word is a few rows a task wherever it stands.

Search.  If two words differ by one inserted, deleted or replaced letter, the
change lies in one half of the first: the other half stands unchanged in the
second.  Two schemes therefore find every neighbour of a word: the first half
is matched exactly and extended to the right, across the second half, with at
most one change; or the second half is matched exactly and extended to the
left, across the first.

Index.  A shard's words, each behind a delimiter, are one cyclic text.  A
pattern is kept as two intervals of equal width: the ranks of the suffixes
that begin with it, and the ranks of its mirror image in the mirrored text.
Wavelet matrices over both Burrows-Wheeler transforms say how often a letter,
and how often smaller letters, stand before an interval's suffixes, so a
pattern grows by a letter on either side, or by every letter that occurs
there, and both intervals follow.  The exact half grows from the middle of
the word outwards to the delimiter, the other half in the opposite direction.
All words searched in a shard advance together.

Shards.  The vocabulary is cut into ranges of words for the first scheme and
ranges of mirrored words for the second, ``SHARD`` words each (and at most
``SHARDS`` ranges).  A word is sent to the ranges that can hold its exact half
with one change behind it: nearly always one, however many words share a
beginning.

Forms.  A word's form is its most frequent neighbour, if that is twice as
frequent at least; counts grow along forms, so following them ends.  Roots
come by doubling the steps in rounds, each written to the shared folder.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterable
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import keep_table, read_table, text_or_empty

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
SHARD, SHARDS = 8192, 4096  # words of a shard; number of shards at most
TABLE = 1 << 18  # words a task counts before it passes them on
CHUNK = 4096  # words searched together
LETTERS = re.compile("[a-zÀ-ÿ]+")
FIRST, SECOND = 0, 1  # which half is matched exactly


def word_counts(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                words_of: Callable[[int | None, dict[str, int]], Iterable[tuple[str, int]]] | None = None) -> DataFrame:
    """``word``, ``n``: the runs of letters (A-Z lower-cased) of all texts."""
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col))

    def run(batches):
        table: dict[str, int] = {}

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(table.keys(), pa.string()), pa.array(table.values(), pa.int64())],
                                             names=["word", "n"])
            table.clear()
            return out

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                # bytes know no capitals but A-Z
                freq = Counter(LETTERS.findall(text.as_py().lower().decode("utf-8")))
                for word, n in freq.items() if words_of is None else words_of(i, freq):
                    table[word] = table.get(word, 0) + n
                if len(table) >= TABLE:
                    yield flush()
        yield flush()

    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Ranks:
    """Wavelet matrix: ranks of letters in a sequence of codes below ``2**bits``."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.levels = []
        for b in range(bits - 1, -1, -1):
            bit = codes >> b & 1
            ones = np.concatenate([[0], np.cumsum(bit)])
            self.levels.append((b, ones, len(codes) - ones[-1]))
            codes = np.concatenate([codes[bit == 0], codes[bit == 1]])
        self.begin = np.zeros(1 << bits, np.int64)  # where a letter's places start in the last order
        kinds, first = np.unique(codes, return_index=True)
        self.begin[kinds] = first

    def of(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """How many ``c`` stand before ``lo``, how many in [lo, hi), how many smaller letters there."""
        smaller = np.zeros(len(lo), np.int64)
        for b, ones, zeros in self.levels:
            lo1, hi1 = ones[lo], ones[hi]
            one = (c >> b & 1).astype(bool)
            smaller += np.where(one, (hi - hi1) - (lo - lo1), 0)
            lo, hi = np.where(one, zeros + lo1, lo - lo1), np.where(one, zeros + hi1, hi - hi1)
        return lo - self.begin[c], hi - lo, smaller

    def every(self, lo: np.ndarray, hi: np.ndarray):
        """The same for every letter in [lo, hi): which interval, letter, before, width, smaller."""
        of, c, smaller = np.arange(len(lo)), np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for _, ones, zeros in self.levels:
            lo1, hi1 = ones[lo], ones[hi]
            lo0, hi0 = lo - lo1, hi - hi1
            a, b = np.flatnonzero(hi0 > lo0), np.flatnonzero(hi1 > lo1)
            of, c = np.concatenate([of[a], of[b]]), np.concatenate([2 * c[a], 2 * c[b] + 1])
            smaller = np.concatenate([smaller[a], smaller[b] + (hi0 - lo0)[b]])
            lo, hi = np.concatenate([lo0[a], zeros + lo1[b]]), np.concatenate([hi0[a], zeros + hi1[b]])
        return of, c, lo - self.begin[c], hi - lo, smaller


def rotations(codes: np.ndarray) -> np.ndarray:
    """Start places of the rotations of ``codes`` in their order (all must differ)."""
    n, k = len(codes), 1
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    at = np.arange(n)
    while True:
        key = rank * n + rank[(at + k) % n]
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        if rank[order[-1]] == n - 1:
            return order
        k *= 2


class BidirectionalIndex:
    """FM-index of delimited words that grows patterns on both sides.

    A pattern is (ranks, width): ``ranks[0]`` among the suffixes of the text,
    ``ranks[1]`` among those of the mirrored text.  Code 0 is the delimiter."""

    LEFT, RIGHT = 0, 1

    def __init__(self, words: list[str], letters: np.ndarray):
        text, start = encode(words, letters)
        codes = np.insert(text, start[:-1], 0)
        self.n = len(codes)
        bits = int(len(letters)).bit_length()
        self.less = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(letters) + 1))])
        self.places = rotations(codes)
        mirrored = codes[::-1]
        self.ranks = [Ranks(codes[self.places - 1], bits), Ranks(mirrored[rotations(mirrored) - 1], bits)]
        self.word_at = np.cumsum(codes == 0) - 1  # the word that a place belongs to

    def everything(self, n: int):
        return [np.zeros(n, np.int64), np.zeros(n, np.int64)], np.full(n, self.n)

    def grow(self, side: int, c: np.ndarray, ranks, width):
        before, wide, smaller = self.ranks[side].of(c, ranks[side], ranks[side] + width)
        out = [ranks[1 - side] + smaller] * 2
        out[side] = self.less[c] + before
        return out, wide

    def grow_every(self, side: int, ranks, width):
        of, c, before, wide, smaller = self.ranks[side].every(ranks[side], ranks[side] + width)
        out = [ranks[1 - side][of] + smaller] * 2
        out[side] = self.less[c] + before
        return of, c, out, wide


def encode(words: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (from 1 on) of all words' letters, and where each word begins and the last ends."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return np.searchsorted(letters, points) + 1, np.cumsum([0, *map(len, words)])


def _take(state, at):
    q, pos, ranks, width = state
    return q[at], pos[at], [r[at] for r in ranks], width[at]


def _join(states):
    return (np.concatenate([s[0] for s in states]), np.concatenate([s[1] for s in states]),
            [np.concatenate([s[2][k] for s in states]) for k in (0, 1)], np.concatenate([s[3] for s in states]))


def search(index: BidirectionalIndex, words: list[str], letters: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (number in ``words``, number in the index) that differ by one
    change and share the half ``half`` (``FIRST`` or ``SECOND``)."""
    out, back = (index.RIGHT, index.LEFT) if half == FIRST else (index.LEFT, index.RIGHT)
    # a word as it is read: the exact half from the middle to its edge, a delimiter, the other half, a delimiter
    read = [w[: len(w) // 2][::-1] + w[len(w) // 2 :] if half == FIRST else w[len(w) // 2 :] + w[: len(w) // 2][::-1]
            for w in words]
    codes, start = encode(read, letters)
    size = np.diff(start)
    seed = size // 2 if half == FIRST else size - size // 2
    start = start[:-1]

    def letter(q, pos):  # the delimiter behind the last
        inside = pos < size[q]
        return np.where(inside, codes[np.where(inside, start[q] + pos, 0)], 0)

    ranks, width = index.everything(len(words))
    live = (np.arange(len(words)), np.zeros(len(words), np.int64), ranks, width)
    ready = []
    while len(live[0]):
        q, pos, ranks, width = live
        edge = pos == seed[q]
        ranks, width = index.grow(back, np.where(edge, 0, letter(q, pos)), ranks, width)
        live = (q, pos + ~edge, ranks, width)
        ready.append(_take(live, np.flatnonzero(edge & (width > 0))))
        live = _take(live, np.flatnonzero(~edge & (width > 0)))
    exact = _join(ready) if ready else live
    changed = _take(exact, slice(0, 0))
    found = []
    while len(exact[0]) or len(changed[0]):
        # with the change made, letter by letter to the delimiter
        q, pos, ranks, width = changed
        ranks, width = index.grow(out, letter(q, pos), ranks, width)
        keep = np.flatnonzero(width > 0)
        q, pos, ranks, width = _take((q, pos, ranks, width), keep)
        done = pos == size[q]
        found.append((q[done], index.word_at[index.places[ranks[0][done]]]))
        moved = [_take((q, pos + 1, ranks, width), np.flatnonzero(~done))]
        # without it yet: every letter that occurs here
        q, pos, ranks, width = exact
        here = letter(q, pos)
        # a letter of the word left out (of equal ones, the last)
        drop = np.flatnonzero((pos < size[q]) & (here != letter(q, pos + 1)))
        moved.append(_take((q, pos + 1, ranks, width), drop))
        of, c, ranks, width = index.grow_every(out, ranks, width)
        q, pos, here = q[of], pos[of], here[of]
        grown = (q, pos, ranks, width)
        other = (c != here) & (c != 0)
        moved.append(_take(grown, np.flatnonzero(other)))  # a letter put in
        moved.append(_take((q, pos + 1, ranks, width), np.flatnonzero(other & (pos < size[q]))))  # replaced
        exact = _take((q, pos + 1, ranks, width), np.flatnonzero((c == here) & (pos < size[q])))
        changed = _join(moved)
    pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*found)] if found else np.empty((2, 0), np.int64), 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def may_hold(prefix: str, word: str, exact: int) -> bool:
    """Can a word that begins with ``prefix`` come from ``word`` by one change
    behind its first ``exact`` letters (or by none)?"""
    m = len(prefix)
    if m <= exact:
        return True
    j = len(commonprefix([prefix, word]))
    return j == m or (j >= exact and (prefix[j + 1 :] in (word[j + 1 : m], word[j : m - 1])
                                      or prefix[j:] == word[j + 1 : m + 1]))


def _search_shard(half: int, index_words: list[str], index_n: np.ndarray, words: list[str]):
    """Per word: number of neighbours, the most frequent one's count and itself (-1: none)."""
    order = sorted(range(len(index_words)), key=index_words.__getitem__)  # ties go to the smaller word
    index_words, index_n = [index_words[i] for i in order], index_n[order]
    letters = np.unique(np.frombuffer("".join(index_words + words).encode("utf-32-le"), np.uint32))
    index = BidirectionalIndex(index_words, letters)
    near, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
    for at in range(0, len(words), CHUNK):
        part = words[at : at + CHUNK]
        q, v = search(index, part, letters, half)
        if half == SECOND:  # what shares the first half too has been found there
            new = [part[i][: len(part[i]) // 2] != index_words[j][: len(part[i]) // 2] for i, j in zip(q, v)]
            q, v = q[new], v[new]
        near[at : at + CHUNK] = np.bincount(q, minlength=len(part))
        by = np.lexsort((v, -index_n[v], q))
        q, v = q[by], v[by]
        first = np.r_[True, q[1:] != q[:-1]] if len(q) else np.empty(0, bool)
        best[at + q[first]] = v[first]
    return near, best, index_words, index_n


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """``word``, ``n`` (distinct words) to ``word``, ``n``, ``n_near`` (words one
    change away), ``form_n`` and ``form`` (the most frequent of them, the
    least in code-point order of equals; null if there is none)."""
    shards = min(SHARDS, max(1, -(-vocabulary.count() // SHARD)))

    def ranges(half: int) -> DataFrame:
        key = F.col("word") if half == FIRST else F.reverse("word")
        placed = vocabulary.repartitionByRange(shards, key).select(
            "word", "n", F.lit(half).alias("half"), F.spark_partition_id().alias("shard"), key.alias("key"))
        return keep_table(placed, "word-ranges")

    def sent(placed: DataFrame, half: int) -> DataFrame:
        held = sorted(tuple(r) for r in placed.groupBy("shard").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
                      .select("lo", "hi", "shard").collect())  # a row a shard, SHARDS at most
        los, his = [h[0] for h in held], [h[1] for h in held]
        common = [commonprefix([h[0], h[1]]) for h in held]

        def run(batches):
            for batch in batches:
                at, shard = [], []
                for i, key in enumerate(batch.column("key").to_pylist()):
                    exact = len(key) // 2 if half == FIRST else len(key) - len(key) // 2
                    lo = bisect_left(his, key[:exact])
                    hi = bisect_right(los, key[:exact] + "\U0010ffff")
                    for k in range(lo, hi):
                        if may_hold(common[k], key, exact):
                            at.append(i)
                            shard.append(held[k][2])
                rows = batch.select(["word", "n", "half"]).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(shard, pa.int32()), pa.array([True] * len(at))],
                                                 names=["word", "n", "half", "shard", "asks"])

        return placed.select("word", "n", "half", "key").mapInArrow(
            run, "word string, n long, half int, shard int, asks boolean")

    def find(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        words, n = np.array(table.column("word").to_pylist(), object), table.column("n").to_numpy()
        asked = words[asks].tolist()
        near, best, names, counts = _search_shard(table.column("half")[0].as_py(), words[~asks].tolist(), n[~asks], asked)
        form = [names[b] if b >= 0 else None for b in best]
        return pa.table({"word": pa.array(asked, pa.string()), "n": n[asks], "n_near": near,
                         "form_n": pa.array([int(counts[b]) if b >= 0 else None for b in best], pa.int64()),
                         "form": pa.array(form, pa.string())})

    both = None
    for half in (FIRST, SECOND):
        placed = ranges(half)
        rows = placed.select("word", "n", "half", "shard", F.lit(False).alias("asks")).unionByName(sent(placed, half))
        both = rows if both is None else both.unionByName(rows)
    found = both.groupBy("half", "shard").applyInArrow(find, "word string, n long, n_near long, form_n long, form string")
    top = F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), F.min(top).alias("top")).select(
        "word", "n", "n_near", (-F.col("top.less")).alias("form_n"), F.col("top.form").alias("form"))


def roots(steps: DataFrame) -> DataFrame:
    """``word``, ``root`` (where the steps end) from ``word``, ``form`` (a step, without cycles)."""
    at = keep_table(steps.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = at.select(F.col("word").alias("via"), F.col("root").alias("next"))
        step = keep_table(at.join(further, at.root == further.via, "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def spelling_variants(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, ratio: int = RATIO, words_of=None) -> DataFrame:
    """One row per word of ``df``'s texts with ``min_length`` letters and
    ``min_count`` occurrences: ``word``, ``form``, ``root``, ``n``, ``n_near``,
    ``form_n``.

    Words are runs of A-Z (lower-cased), a-z and U+00C0 to U+00FF.  ``n_near``
    counts the words one inserted, deleted or replaced letter away; ``form``
    is the most frequent of them (ties: the least in code-point order) if it
    is ``ratio`` (2 or more) times as frequent as the word, else null; ``root``
    is where the forms lead, the word itself if it has none.
    ``words_of(id, counts)`` may replace a document's words.  Null and empty
    texts have no words; repeated rows count as often as they come; a null id
    is passed on as None; other columns are ignored; an empty table gives no
    rows.
    """
    if ratio < 2:
        raise ValueError("ratio is 2 or more, or forms might run in circles")
    counted = word_counts(df, id_col=id_col, text_col=text_col, words_of=words_of)
    vocabulary = keep_table(counted.where((F.length("word") >= min_length) & (F.col("n") >= min_count)), "vocabulary")
    near = neighbours(vocabulary)
    formed = F.col("form_n") >= ratio * F.col("n")
    near = keep_table(near.select("word", "n", "n_near", F.when(formed, F.col("form")).alias("form"),
                                  F.when(formed, F.col("form_n")).alias("form_n")), "neighbours")
    ends = roots(near.where("form IS NOT NULL"))
    return near.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def planted(doc_id: int | None, freq: dict[str, int]) -> Iterable[tuple[str, int]]:
    """The words the query's contract puts in place of a document's own: some
    (by CRC-32 of id and word) lose a letter.  A null id changes nothing."""
    if doc_id is None:
        return freq.items()
    of, crc = zlib.crc32(b"%d:" % doc_id), zlib.crc32
    out = []
    for word, n in freq.items():
        h = crc(word.encode("utf-8"), of)
        if h % 97 == 0:
            i = h % len(word)
            word = word[:i] + word[i + 1 :]
        out.append((word, n))
    return out


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form and root."""
    return spelling_variants(read_table(spark, sf_dir, "documents"), words_of=planted)
