"""Toxicity from a learned lexicon, matched with spelling errors, in context.

Lexicon.  Words, and stems with several endings, that labelled toxic
documents use and clean ones do not (log-likelihood ratio and purity over
document counts).  It is learned from a bounded sample of the rows that may
be learned from, and holds at most ``MAX_TERMS`` entries.

Matching.  The lexicon is a trie.  A word is matched by the Levenshtein
automaton intersected with the trie: a state is the set of (trie node, edits
so far) that the letters read can have reached.  States are made
deterministic as they are met and their transitions kept, so that a known
prefix costs one table look-up per letter and most words die after a few.
Words of ``FUZZY_LENGTH`` letters or more may differ by one edit, unless
clean documents of the sample use words as near as that.

Context.  Every match is seen in a window of ``WINDOW`` words: a match inside
quotation marks counts apart from one that is not, and other matches in the
window add to it.  A logistic regression over a document's match counts gives
its score; what a quotation is worth is learned from the labels.  A misspelled
match is worth what an exact one is: labelled toxic documents are learned
from a second time, with their exact matches counted as misspelled ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import map_texts, read_table, text_or_empty
from tablewright.llm.minhash import WORDS, _Words, mix, shingles
from tablewright.llm.quality import at_threshold, best_cut, fold, training_sample

FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
MAX_TRAIN_DOCS = 6000
MAX_TERMS = 400
FUZZY_LENGTH = 5
WINDOW = 8
STEM_LENGTHS = (4, 5, 6, 7)
MIN_RATIO, MIN_PURITY = 30.0, 0.93
EXACT, FUZZY, STEM = 1, 2, 3

QUOTES = "\"“”„«»‹›‘’'`"
_TRIM = re.compile(r"^\W+|\W+$")
_PART = re.compile(r"[^\W_]+")
_KNOWN = 1 << 18  # words kept per task


def _words(chunk: str) -> list[str]:
    """A run without white space, its outer marks aside, then its parts if marks stand inside."""
    word = _TRIM.sub("", chunk)
    parts = _PART.findall(word)
    return [word] if parts == [word] else [word, *parts]


class Lexicon:
    """The automaton; ``words`` maps every word seen to its kind of match."""

    def __init__(self, words: list[str], stems: list[str], exact: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word_at: dict[int, int] = {}  # node -> edits allowed
        self.stem_at: set[int] = set()
        self.fuzzy: list[bool] = [False]  # does a word that allows an edit end below?
        as_is = frozenset(exact)
        for w in words:
            edits = int(len(w) >= FUZZY_LENGTH and w not in as_is)
            self.word_at[self._add(w, bool(edits))] = edits
        for s in stems:
            self.stem_at.add(self._add(s, False))
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.delta: list[dict[str, int]] = []
        self.start = self._state(frozenset(self._skips({(0, 0)})))
        self.known: dict[str, tuple[int, ...]] = {}

    def _add(self, term: str, fuzzy: bool) -> int:
        node = 0
        for ch in term:
            self.fuzzy[node] |= fuzzy
            if ch not in self.children[node]:
                self.children[node][ch] = len(self.children)
                self.children.append({})
                self.fuzzy.append(False)
            node = self.children[node][ch]
        self.fuzzy[node] |= fuzzy
        return node

    def _skips(self, items: set) -> set:
        """Adds what a letter missing from the word reaches."""
        return items | {(child, 1) for node, e in items if e == 0 for child in self.children[node].values()
                        if self.fuzzy[child]}

    def _state(self, items: frozenset) -> int:
        got = self.states.get(items)
        if got is None:
            got = self.states[items] = len(self.sets)
            self.sets.append(items)
            self.delta.append({})
        return got

    def _step(self, state: int, ch: str) -> int:
        out = set()
        for node, e in self.sets[state]:
            if node in self.stem_at and e == 0:
                out.add((node, 0))  # a stem takes any ending
            child = self.children[node].get(ch)
            if child is not None and (e == 0 or self.fuzzy[child]):
                out.add((child, e))
            if e == 0 and self.fuzzy[node]:
                out.add((node, 1))  # a letter too many
                out.update((c, 1) for c in self.children[node].values() if self.fuzzy[c])  # another letter
        got = self.delta[state][ch] = self._state(frozenset(self._skips(out))) if out else -1
        return got

    def match(self, word: str) -> int:
        """0: no match, else EXACT, FUZZY or STEM."""
        state = self.start
        delta = self.delta
        for ch in word:
            to = delta[state].get(ch)
            state = self._step(state, ch) if to is None else to
            if state < 0:
                return 0
        items = self.sets[state]
        if any(e == 0 and node in self.word_at for node, e in items):
            return EXACT
        if any(e == 0 and node in self.stem_at for node, e in items):
            return STEM
        if any(self.word_at.get(node, -1) >= e for node, e in items):
            return FUZZY
        return 0

    def kinds(self, chunk: str) -> tuple[int, ...]:
        """Matches of a run without white space: itself, its outer marks aside, or else its parts."""
        got = self.known.get(chunk)
        if got is None:
            if len(self.known) >= _KNOWN:
                self.known.clear()
            word, *parts = _words(chunk)
            whole = self.match(word)
            got = self.known[chunk] = (whole,) if whole else tuple(filter(None, map(self.match, parts)))
        return got


def _quoted(chunks: list[str], at: int) -> bool:
    """Is the word inside quotation marks: its own, or marks on both sides in the window?"""
    chunk = chunks[at]
    if len(chunk) > 1 and chunk[0] in QUOTES and any(c in QUOTES for c in chunk[1:]):
        return True
    before = any(c[0] in QUOTES for c in chunks[max(0, at - WINDOW) : at + 1])
    after = any(c.rstrip(".,;:!?")[-1:] in QUOTES and c.rstrip(".,;:!?")[-1:] for c in chunks[at : at + WINDOW + 1])
    return before and after


def features(lexicon: Lexicon, text: str) -> list[float]:
    """Counts of matches by kind, outside and inside quotations, with what their windows add."""
    chunks = text.lower().split()
    matches = [(i, k) for i, c in enumerate(chunks) for k in lexicon.kinds(c)]
    places = [i for i, _ in matches]
    if not places:
        return [0.0] * 9
    out = {(k, q): 0 for k in (EXACT, FUZZY, STEM) for q in (False, True)}
    close = 0
    for n, (i, kind) in enumerate(matches):
        out[kind, _quoted(chunks, i)] += 1
        close += n > 0 and i - places[n - 1] <= WINDOW
    return [*(math.log1p(v) for v in out.values()), math.log1p(close), len(set(places)) / len(chunks),
            float(any(not q and v for (_, q), v in out.items()))]


def _ratio(a: int, b: int, na: int, nb: int) -> float:
    """Log-likelihood ratio of a of na against b of nb."""
    def part(k, n, p):
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n > k else 0.0)

    p = (a + b) / (na + nb)
    return 2 * (part(a, na, a / na) + part(b, nb, b / nb) - part(a, na, p) - part(b, nb, p))


def _own_texts(texts: list[str], labels: list[int]) -> list[tuple[str, int]]:
    """One text of every group of near copies with a label: words that copies
    share say nothing about the label.  Texts that share one of four least
    shingle hashes are taken for copies."""
    table, seen, out = _Words(), set(), []
    for text, label in zip(texts, labels):
        s = shingles(text, WORDS, table)
        marks = {(k, label, int(mix(s + np.uint64(k)).min())) for k in range(4)} if len(s) else {(0, label, 0)}
        if seen.isdisjoint(marks):
            out.append((text, label))
        seen |= marks
    return out


def fit(texts: list[str], labels: list[int]) -> dict:
    """The lexicon and the weights; without both kinds of documents, the share of toxic ones."""
    y = np.array(labels, np.float64)
    if len(set(labels)) < 2:
        return {"constant": float(y.mean()) if labels else 0.0}
    toxic, clean, forms = Counter(), Counter(), {}
    own = _own_texts(texts, labels)
    for text, label in own:
        seen = {w for c in text.lower().split() for w in _words(c) if w}
        terms = {(w, False) for w in seen}
        for w in seen:
            for n in STEM_LENGTHS:
                if len(w) > n:
                    terms.add((w[:n], True))
                    if label:
                        forms.setdefault(w[:n], set()).add(w)
        (toxic if label else clean).update(terms)
    na = sum(label for _, label in own)
    nb = len(own) - na
    good = []
    for (term, stem), a in toxic.items():
        b = clean[term, stem]
        if a / na > b / nb and a / na / (a / na + b / nb) >= MIN_PURITY and (not stem or len(forms[term]) >= 3):
            r = _ratio(a, b, na, nb)
            if r >= MIN_RATIO:
                good.append((r, term, stem))
    good = sorted(good, key=lambda g: (-g[0], g[1]))[:MAX_TERMS]
    words = [t for _, t, stem in good if not stem and len(t) > 2]
    stems = sorted((t for _, t, stem in good if stem), key=len)
    stems = [s for i, s in enumerate(stems) if not any(s.startswith(t) for t in stems[:i])]
    # no edits for one ending among many of a stem, and for words that clean words come near to
    exact = {w for w in words for t in stems if w.startswith(t) and toxic[w, False] < toxic[t, True] / 2}
    every = Lexicon(words, stems, sorted(exact))
    near = [w for (w, stem) in clean if not stem and every.match(w) == FUZZY]
    for word in set(words) - exact:
        alone = Lexicon([word], [], [])
        if any(abs(len(w) - len(word)) < 2 and alone.match(w) == FUZZY for w in near):
            exact.add(word)
    lexicon = Lexicon(words, stems, sorted(exact))
    x = np.array([features(lexicon, t) for t in texts])
    again = x[(y > 0) & (x[:, :2].sum(1) > 0)]
    again[:, 2:4] += again[:, :2]
    again[:, :2] = 0
    x, y = np.concatenate([x, again]), np.concatenate([y, np.ones(len(again))])
    w, bias = np.zeros(x.shape[1]), -1.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for k in range(1, 401):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30)))
        g = np.append(x.T @ (y - p) / len(y) - 1e-3 * w, np.mean(y - p))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        w, bias = w + step[:-1], bias + step[-1]
    model = {"words": words, "stems": stems, "exact": sorted(exact), "w": w, "bias": float(bias)}
    model["cut"] = best_cut(_raw(model, x), y)
    return model


def _raw(model: dict, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ model["w"] + model["bias"], -30, 30)))


def score_toxicity(df: DataFrame, model: dict, *, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, ``score`` of every whole text.

    A null text counts as empty; a text without matches has the score of no
    match; repeated rows come out as often as they came in; a null id stays
    null; other columns are dropped."""
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col))

    def work():
        lexicon = None if "constant" in model else Lexicon(model["words"], model["stems"], model["exact"])

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            if lexicon is None:
                score = np.full(batch.num_rows, model["constant"])
            else:
                x = np.array([features(lexicon, t) for t in batch.column(1).to_pylist()]).reshape(batch.num_rows, -1)
                score = at_threshold(_raw(model, x), model["cut"], threshold)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())],
                                              names=[id_col, "score"])
        return run

    return map_texts(src, f"{id_col} long, score double", work)


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> dict:
    sample = training_sample(docs, labels, "toxic", FOLDS, HELD_OUT, max_docs=MAX_TRAIN_DOCS)
    return fit([t for t, _ in sample], [y for _, y in sample])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", F.coalesce(fold(FOLDS, HELD_OUT), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
