"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad.  Unary features describe the line itself
(shares of character classes, word lengths, repeated words, whether the line
occurs again in the document) and its two neighbours; transition weights tie
adjacent labels.  The forward-backward marginals of "good", weighted by line
length, give the document's raw quality; a fitted cut on it becomes the
threshold of the score.

Training uses documents' labels only, on a bounded sample: at most
``MAX_TRAIN_DOCS`` labelled documents, of ``MAX_TRAIN_BYTES`` together, chosen
by a hash of the id.  Lines start with the label of their
document; between rounds the lines of bad documents that the model holds for
good are relabelled, so that a bad document may have good lines.  The
transition weights are learned with the unary weights by gradient ascent on
the conditional likelihood.  The fitted model is a few dozen numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import map_texts, read_table, text_or_empty

MAX_TRAIN_DOCS = 4000
MAX_TRAIN_BYTES = 24 << 20  # of their texts together
CHUNK = 256  # lines of a text that are walked one after the other in scoring
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3

# classes of UTF-8 bytes: 0 other, 1 a-z, 2 A-Z, 3 digit, 4 space, 5 sentence marks, 6 exclamation, 7 symbols, 8 beyond ASCII
_CLASS = np.zeros(256, np.uint8)
for _c, _chars in ((1, b"abcdefghijklmnopqrstuvwxyz"), (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, b"0123456789"),
                   (4, b" \t\r"), (5, b".,;:'\"()-?"), (6, b"!"), (7, b"#$%&*+/<=>@[\\]^_`{|}~")):
    _CLASS[list(_chars)] = _c
_CLASS[128:] = 8
_OWN = 14  # features of the line itself, without the constant


class Lines:
    """Feature rows of the lines of many texts; ``first[i]`` is where text i begins."""

    def __init__(self, texts: list[str]):
        blobs, counts, rows = [], [], []
        for text in texts:
            lines = text.split("\n")
            seen: dict[str, int] = {}
            for line in lines:
                seen[line] = seen.get(line, 0) + 1
            for line in lines:
                words = line.split()
                n = len(words)
                twice = sum(map(str.__eq__, words, words[1:])) / n if n > 1 else 0.0
                rows.append((n, len(set(words)) / n if n else 1.0, twice, 1.0 if seen[line] > 1 and n > 2 else 0.0))
            blobs.append(text)
            counts.append(len(lines))
        data = np.frombuffer(("\n".join(blobs) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
        ends = np.flatnonzero(data == 10)
        starts = np.concatenate([[0], ends[:-1] + 1])
        self.size = (ends - starts).astype(np.float64)
        cls = _CLASS[data]
        share = []
        for c in range(1, 9):
            upto = np.concatenate([[0], np.cumsum(cls == c, dtype=np.int64)])
            share.append((upto[ends] - upto[starts]) / np.maximum(self.size, 1))
        words = np.array(rows, np.float64).reshape(-1, 4)
        n, unique, twice, again = words.T
        small, upper, digit, space, marks, shout, symbol, far = share
        own = [upper / np.maximum(upper + small, 0.02), digit, space, marks, shout * 5, symbol * 5, far, small,
               np.log1p(n) / 5, np.minimum(self.size / np.maximum(n, 1), 30) / 10, unique, twice, again,
               (n == 0).astype(float)]
        own = np.stack(own, 1)
        counts = np.array(counts)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.counts = counts
        doc = np.repeat(np.arange(len(texts)), counts)
        same = np.zeros(len(doc) + 1, bool)
        same[1:-1] = doc[1:] == doc[:-1]
        before = np.where(same[:-1, None], np.roll(own, 1, 0), own)
        after = np.where(same[1:, None], np.roll(own, -1, 0), own)
        self.x = np.concatenate([np.ones((len(own), 1)), own, (before + after) / 2], 1)
        self.doc = doc


def _chains(counts: np.ndarray, first: np.ndarray):
    """For every position, the rows that stand there: (rows, rows before) per
    step, of texts that are long enough; texts longest first."""
    order = np.argsort(-counts, kind="stable")
    sizes, starts = counts[order], first[:-1][order]
    alive = len(order)
    for t in range(int(sizes[0]) if len(sizes) else 0):
        while alive and sizes[alive - 1] <= t:
            alive -= 1
        yield starts[:alive] + t


def marginals(unary: np.ndarray, trans: np.ndarray, counts: np.ndarray, first: np.ndarray):
    """Forward-backward over all texts at once: marginals (lines, 2), summed
    pair marginals (2, 2), log partition."""
    steps = list(_chains(counts, first))
    alpha, beta = np.empty_like(unary), np.zeros_like(unary)
    log_z = 0.0
    for t, rows in enumerate(steps):
        a = unary[rows]
        if t:
            prev = alpha[rows - 1]
            a = a + np.logaddexp(prev[:, :1] + trans[0], prev[:, 1:] + trans[1])
        alpha[rows] = a
    for t in range(len(steps) - 2, -1, -1):
        rows = steps[t + 1] - 1  # those that have a line after this one
        ahead = unary[rows + 1] + beta[rows + 1]
        beta[rows] = np.logaddexp(ahead[:, :1] + trans[:, 0], ahead[:, 1:] + trans[:, 1])
    both = alpha + beta
    z = np.logaddexp(both[:, 0], both[:, 1])
    log_z = float(z[first[:-1][counts > 0]].sum())
    out = np.exp(both - z[:, None])
    pairs = np.zeros((2, 2))
    for t in range(1, len(steps)):
        rows = steps[t]
        p = (alpha[rows - 1][:, :, None] + trans[None] + (unary[rows] + beta[rows])[:, None, :]
             - z[rows][:, None, None])
        pairs += np.exp(p).sum(0)
    return out, pairs, log_z


def line_marginals(unary: np.ndarray, trans: np.ndarray, counts: np.ndarray, first: np.ndarray,
                   chunk: int = CHUNK) -> np.ndarray:
    """The line marginals of ``marginals``, for texts of any number of lines.

    Texts are cut into pieces of ``chunk`` lines, and all pieces are walked at
    once: forwards for either state before the piece, backwards for either
    state at its end.  Then only the pieces of a text follow one another."""
    pieces = -(-counts // chunk)
    text = np.repeat(np.arange(len(counts)), pieces)
    begin = np.concatenate([[0], np.cumsum(pieces)])
    nth = np.arange(len(text)) - begin[text]
    start = first[text] + nth * chunk
    size = np.minimum(counts[text] - nth * chunk, chunk)
    if not len(text):
        return np.empty((0, 2))
    at = np.concatenate([[0], np.cumsum(size)])
    steps = list(_chains(size, np.append(start, 0)))
    # forwards: states before the piece, own state
    f = np.empty((len(unary), 2, 2))
    for t, rows in enumerate(steps):
        if t:
            f[rows] = np.logaddexp(f[rows - 1, :, :1] + trans[0], f[rows - 1, :, 1:] + trans[1]) + unary[rows][:, None]
        else:
            f[rows] = np.where(np.isin(rows, first[:-1])[:, None, None], 0.0, trans) + unary[rows][:, None]
    # backwards: own state, state at the piece's last line
    g = np.full((len(unary), 2, 2), -np.inf)
    last = start + size - 1
    g[last, [[0], [1]], [[0], [1]]] = 0.0
    for t in range(len(steps) - 2, -1, -1):
        rows = steps[t + 1] - 1
        ahead = unary[rows + 1][:, :, None] + g[rows + 1]
        g[rows] = np.logaddexp(trans[:, :1] + ahead[:, :1], trans[:, 1:] + ahead[:, 1:])
    # from piece to piece: what reaches it from before, what follows its end
    reach, follow = np.zeros((len(text), 2)), np.zeros((len(text), 2))
    for k in range(1, int(pieces.max())):
        p = begin[:-1][pieces > k] + k
        e = f[last[p - 1]]
        through = np.logaddexp(reach[p - 1, :1] + e[:, 0], reach[p - 1, 1:] + e[:, 1])
        reach[p] = np.where((nth[p - 1] > 0)[:, None], through, e[:, 0])
    for k in range(int(pieces.max()) - 2, -1, -1):
        p = begin[:-1][pieces > k + 1] + k
        b = g[start[p + 1]]
        after = unary[start[p + 1]] + np.logaddexp(b[:, :, 0] + follow[p + 1, :1], b[:, :, 1] + follow[p + 1, 1:])
        follow[p] = np.logaddexp(trans[:, 0] + after[:, :1], trans[:, 1] + after[:, 1:])
    own = np.repeat(np.arange(len(text)), size)
    line = np.repeat(start - at[:-1], size) + np.arange(at[-1])
    r, e = reach[own], f[line]
    alpha = np.where((nth[own] > 0)[:, None], np.logaddexp(r[:, :1] + e[:, 0], r[:, 1:] + e[:, 1]), e[:, 0])
    w, b = follow[own], g[line]
    both = alpha + np.logaddexp(b[:, :, 0] + w[:, :1], b[:, :, 1] + w[:, 1:])
    out = np.empty_like(unary)
    out[line] = np.exp(both - np.logaddexp(both[:, :1], both[:, 1:]))
    return out


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def _raw(good: np.ndarray, lines: Lines) -> np.ndarray:
    """Length-weighted mean of the lines' marginals, per text."""
    weight = lines.size + 1
    n = len(lines.counts)
    return np.bincount(lines.doc, weight * good, n) / np.maximum(np.bincount(lines.doc, weight, n), 1e-9)


def best_cut(raw: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest errors; the middle, where several are as good."""
    cuts = np.unique(np.concatenate([np.quantile(raw, np.linspace(0, 1, 400)), raw[y > 0][:400], [0.5]]))
    wrong = [np.sum(raw[y > 0] < c) + np.sum(raw[y == 0] >= c) for c in cuts]
    best = cuts[np.array(wrong) == min(wrong)]
    return float(np.clip((best[0] + best[-1]) / 2, 1e-6, 1 - 1e-6))


def at_threshold(raw: np.ndarray, cut: float, threshold: float) -> np.ndarray:
    """Raw values in 0 to 1 stretched in two straight parts so that ``cut`` becomes ``threshold``."""
    low = threshold * raw / cut
    high = threshold + (1 - threshold) * (raw - cut) / (1 - cut)
    return np.clip(np.where(raw < cut, low, high), 0.0, 1.0)


def fit(texts: list[str], labels: list[int], *, rounds: int = 2, steps: int = 120, rate: float = 0.15,
        ridge: float = 1e-3) -> dict:
    """The model: unary weights, transitions, scaling and the cut.

    Without both kinds of documents the score is the share of good ones."""
    y = np.array(labels, np.float64)
    if len(set(labels)) < 2:
        return {"constant": float(y.mean()) if labels else 0.5}
    lines = Lines(texts)
    mean, std = lines.x.mean(0), lines.x.std(0) + 1e-6
    mean[0], std[0] = 0.0, 1.0
    x = (lines.x - mean) / std
    doc_y = y[lines.doc]
    target = doc_y.copy()
    # a rare kind of document weighs as much as the common one
    balance = np.where(doc_y > 0, 0.5 / max(doc_y.mean(), 1e-6), 0.5 / max(1 - doc_y.mean(), 1e-6))
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    pair_from = np.flatnonzero(np.diff(lines.doc) == 0)
    for _ in range(rounds):
        m1, v1 = np.zeros(len(w)), np.zeros(len(w))
        for k in range(1, 61):  # start: each line by itself
            g = x.T @ (balance * (target - _sigmoid(x @ w))) / len(x) - ridge * w
            m1, v1 = 0.9 * m1 + 0.1 * g, 0.999 * v1 + 0.001 * g * g
            w = w + rate * (m1 / (1 - 0.9**k)) / (np.sqrt(v1 / (1 - 0.999**k)) + 1e-8)
        # in a bad document the lines that look good are good, unless all of them do
        p = _sigmoid(x @ w)
        worst = np.full(len(y), 2.0)
        np.minimum.at(worst, lines.doc, p)
        target = np.where((doc_y == 0) & (p > 0.5) & (worst[lines.doc] < 0.5), 1.0, doc_y)
    theta = np.concatenate([w, trans.ravel()])
    m1, v1 = np.zeros(len(theta)), np.zeros(len(theta))
    seen = np.zeros((2, 2))
    np.add.at(seen, (target[pair_from].astype(int), target[pair_from + 1].astype(int)), 1)
    for k in range(1, steps + 1):
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        unary = np.stack([np.zeros(len(x)), x @ w], 1)
        marg, pairs, _ = marginals(unary, trans, lines.counts, lines.first)
        g = np.concatenate([x.T @ (target - marg[:, 1]) / len(x), ((seen - pairs) / len(x)).ravel()]) - ridge * theta
        m1, v1 = 0.9 * m1 + 0.1 * g, 0.999 * v1 + 0.001 * g * g
        theta = theta + rate / 3 * (m1 / (1 - 0.9**k)) / (np.sqrt(v1 / (1 - 0.999**k)) + 1e-8)
    model = {"mean": mean, "std": std, "w": theta[:-4], "trans": theta[-4:].reshape(2, 2)}
    raw = raw_quality(model, lines)
    model["cut"] = best_cut(raw, y)
    return model


def raw_quality(model: dict, lines: Lines) -> np.ndarray:
    x = (lines.x - model["mean"]) / model["std"]
    unary = np.stack([np.zeros(len(x)), x @ model["w"]], 1)
    return _raw(line_marginals(unary, model["trans"], lines.counts, lines.first)[:, 1], lines)


def scores(model: dict, texts: list[str], threshold: float = THRESHOLD) -> np.ndarray:
    """Score of every text, 0 to 1; the fitted cut comes out as ``threshold``."""
    if not texts:
        return np.empty(0)
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    return at_threshold(raw_quality(model, Lines(texts)), model["cut"], threshold)


def training_sample(docs: DataFrame, labels: DataFrame, target: str, folds: int, held_out: int, *,
                    max_docs: int = MAX_TRAIN_DOCS, max_bytes: int = MAX_TRAIN_BYTES) -> list[tuple[str, int]]:
    """At most ``max_docs`` (text, label) of the folds that may be learned
    from, by a hash of the id, and of these as many as ``max_bytes`` hold, long
    texts like any other.  A null text counts as empty.  Only the chosen ids
    are broadcast (their number is bounded), so no other text is shuffled."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
        .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held_out)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(target).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).collect()
    )
    spark = docs.sparkSession
    ids = spark.createDataFrame([(i, r.doc_id, r.label) for i, r in enumerate(chosen)], "nth int, doc_id long, label int")
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text")).join(F.broadcast(ids), "doc_id")
        .groupBy("nth").agg(F.max("text").alias("text"), F.max("label").alias("label"))
    )
    # at most max_docs rows: one task may add up their sizes
    upto = F.sum(F.octet_length("text")).over(Window.orderBy("nth"))
    rows = rows.withColumn("upto", upto).where((F.col("upto") <= max_bytes) | (F.col("nth") == 0)).orderBy("nth").collect()
    return [(r.text, r.label) for r in rows]


def fold(folds: int, held_out: int):
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_out)


def fit_quality(docs: DataFrame, labels: DataFrame) -> dict:
    sample = training_sample(docs, labels, "quality", FOLDS, HELD_OUT)
    return fit([t for t, _ in sample], [y for _, y in sample])


def score_quality(df: DataFrame, model: dict, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` of every whole text.

    A null text counts as empty and an empty text is one empty line; repeated
    rows come out as often as they came in; a null id stays null; other
    columns are dropped."""
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col))

    def work():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(model, batch.column(1).to_pylist()))],
                                              names=[id_col, "score"])
        return run

    return map_texts(src, f"{id_col} long, score double", work)


def keep_good(df: DataFrame, model: dict, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df``, all columns, whose text scores ``threshold`` or more.

    A null text counts as empty (and stays null in a row that is kept);
    repeated rows go or stay together; columns pass through whatever their
    names; an empty table gives no rows."""
    place = df.columns.index(text_col)

    def work():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            return batch.filter(pa.array(scores(model, texts) >= threshold, pa.bool_()))
        return run

    return map_texts(df, df.schema, work, place)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(fold(FOLDS, HELD_OUT), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
