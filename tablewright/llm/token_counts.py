"""Token counts from pre-token frequencies, without token ids.

Byte-pair merges never cross a pre-token, so a document's token count is the
sum, over its distinct pre-tokens, of frequency times the number of pieces
the pre-token falls into.  The texts are cut into pre-tokens once:

1. A slice of texts (``SLICE`` bytes) becomes one row: its distinct
   pre-tokens, most frequent first, and every document's frequencies as
   (place in that list, count) pairs, packed.  Written once.
2. The slices' lists are dealt by pre-token and sorted; each distinct
   pre-token of the whole table is merged once, for its number of pieces, and
   the slices that hold it stand behind one another.  A frequent pre-token is
   one row a slice, so none is hot.  A task packs its numbers by slice.
3. The numbers join their slice's frequencies, where every document's sum is
   one weighted sum over its pairs.

Pre-tokens are cut by the pattern of byte-level vocabularies.  Its classes
depend on the Unicode version, so texts with characters outside the
``SETTLED`` blocks are cut by the library that defines the counts.  Strings
of added tokens count as one token each.
"""

from __future__ import annotations

import json
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.errors import CapabilityError
from tablewright.llm.bpe import WHITE_SPACE, byte_symbols, tokenizer_path
from tablewright.llm.common import keep_table, kept_by_worker, read_table, slices, text_or_empty

SLICE = 16 << 20  # bytes of text in a slice
PACKED = 1 << 20  # numbers a task packs together
LIMIT = 512

# The pattern of byte-level vocabularies, white space spelled out.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^SPACE\p{L}\p{N}]+|[SPACE]+(?![^SPACE])|[SPACE]+"
           .replace("SPACE", WHITE_SPACE))
#: Blocks whose letters, numbers and spaces are the same in all current Unicode versions.
SETTLED = [(0x0, 0x24F), (0x400, 0x4FF), (0x2000, 0x2063), (0x20A0, 0x20AF), (0x2190, 0x23CE),
           (0x2500, 0x26FF), (0x3041, 0x3096), (0x30A1, 0x30FE), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3),
           (0x1F300, 0x1F320)]


def read_spec(path: str) -> str:
    """The tokenizer file at ``path`` (on the driver), as JSON."""
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    spec = json.loads(raw)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    ok = (model["type"] == "BPE" and not model.get("dropout") and spec["normalizer"] is None
          and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"]
          and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]))
    if not ok:
        raise CapabilityError(f"{path}: only byte-level BPE with the usual pattern and no normaliser is supported")
    return raw


class Pieces:
    """Cuts texts into pre-tokens and counts the pieces of one."""

    def __init__(self, raw: str):
        import regex
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(raw)
        self.merge, self.library = tok.model.tokenize, tok.pre_tokenizer.pre_tokenize_str
        self.find = regex.compile(PATTERN).findall
        self.other = regex.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SETTLED) + "]").search
        self.added = sorted((t["content"] for t in json.loads(raw)["added_tokens"]), key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, self.added))).split if self.added else None
        self.symbols = {b: s for b, s in enumerate(byte_symbols())}

    def _parts(self, text: str) -> list[str]:
        if not text.isascii() and self.other(text):
            return [text[a:b] for _, (a, b) in self.library(text)]
        return self.find(text)

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of ``text`` and the number of added tokens in it."""
        if self.cut is None or not any(t in text for t in self.added):
            return self._parts(text), 0
        parts = self.cut(text)
        return list(chain.from_iterable(map(self._parts, parts))), len(parts) - 1

    def size(self, pre_token: str) -> int:
        return len(self.merge(pre_token.encode("utf-8").decode("latin-1").translate(self.symbols)))


def pieces(raw: str) -> Pieces:
    """One per worker process."""
    return kept_by_worker(("pieces", raw), lambda: Pieces(raw))


def pack(places: np.ndarray, counts: np.ndarray) -> bytes:
    """Pairs in few bytes: both as int32, by byte planes."""
    both = np.concatenate([places, counts]).astype("<i4")
    return zstandard.ZstdCompressor(level=1).compress(both.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    both = planes.T.copy().view("<i4").reshape(-1)
    return both[: len(both) // 2], both[len(both) // 2 :]


SLICES = ("slice long, ids array<long>, n_bytes array<long>, added array<long>, ends array<long>, pairs binary, "
          "pre_tokens array<string>")


def slice_frequencies(df: DataFrame, raw: str) -> DataFrame:
    """``id``, ``text`` to one row a slice (``SLICES``): ``pairs`` holds all
    documents' (place in ``pre_tokens``, count), those of document i up to
    ``ends[i]``; places as differences within a document."""
    def run(batches):
        cut, task, number = pieces(raw), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                texts = part.column(1).to_pylist()
                place: dict[str, int] = {}
                docs, counts, added, total = [], [], [], Counter()
                for text in texts:
                    found, extra = cut.pre_tokens(text)
                    freq = Counter(found)
                    docs.append(np.fromiter([place.setdefault(p, len(place)) for p in freq], np.int64, len(freq)))
                    counts.append(np.fromiter(freq.values(), np.int64, len(freq)))
                    added.append(extra)
                # frequent ones first: small places, small differences
                flat, count = np.concatenate(docs), np.concatenate(counts)
                sizes = np.array([len(d) for d in docs])
                order = np.argsort(-np.bincount(flat, minlength=len(place)), kind="stable")
                rank = np.empty(len(place), np.int64)
                rank[order] = np.arange(len(place))
                owner = np.repeat(np.arange(len(docs)), sizes)
                flat = rank[flat]
                by = np.lexsort((flat, owner))
                flat, count = flat[by], count[by]
                ends = np.cumsum(sizes)
                step = np.diff(flat, prepend=0)
                first = (ends - sizes)[sizes > 0]
                step[first] = flat[first]
                names = list(place)
                yield pa.RecordBatch.from_arrays([
                    pa.array([(task << 32) + number], pa.int64()),
                    pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([[len(t) if t.isascii() else len(t.encode("utf-8")) for t in texts]], pa.list_(pa.int64())),
                    pa.array([added], pa.list_(pa.int64())),
                    pa.array([ends], pa.list_(pa.int64())),
                    pa.array([pack(step, count)], pa.binary()),
                    pa.array([[names[i] for i in order]], pa.list_(pa.string())),
                ], names=["slice", "ids", "n_bytes", "added", "ends", "pairs", "pre_tokens"])
                number += 1

    return df.mapInArrow(run, SLICES)


def piece_counts(held: DataFrame, raw: str) -> DataFrame:
    """``slice``, ``place``, ``pre_token`` to ``of`` (a slice) and ``sized``:
    a number per pre-token, its place in the high and its number of pieces in
    the low 32 bits."""
    def run(batches):
        size = pieces(raw).size
        token, of_token = None, 0
        of: list[np.ndarray] = []
        sized: list[np.ndarray] = []
        rows = 0

        def flush():
            at, what = np.concatenate(of), np.concatenate(sized)
            order = np.lexsort((what, at))
            at, what = at[order], what[order]
            start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[start, len(at)].astype(np.int32)), pa.array(what))
            of.clear()
            sized.clear()
            return pa.RecordBatch.from_arrays([pa.array(at[start]), lists], names=["of", "sized"])

        for batch in batches:
            n = []
            for p in batch.column(2).to_pylist():
                if p != token:
                    token, of_token = p, size(p)
                n.append(of_token)
            of.append(batch.column(0).to_numpy())
            sized.append(batch.column(1).to_numpy().astype(np.int64) << 32 | np.array(n, np.int64))
            rows += len(n)
            if rows >= PACKED:
                yield flush()
                rows = 0
        if rows:
            yield flush()

    dealt = held.repartition("pre_token").sortWithinPartitions("pre_token")
    return dealt.select("slice", "place", "pre_token").mapInArrow(run, "of long, sized array<long>")


def count_tokens(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``n_bytes`` (UTF-8) and
    ``n_tokens`` of the whole text under the vocabulary at ``vocabulary``.

    A null text counts as empty and has no tokens; repeated rows come out as
    often as they came in; a null id stays null; other columns are dropped;
    an empty table gives no rows.
    """
    raw = read_spec(vocabulary)
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col))
    cut = keep_table(slice_frequencies(src, raw), "pre-tokens", compression="zstd")
    sized = piece_counts(cut.select("slice", F.posexplode("pre_tokens").alias("place", "pre_token")), raw)

    def total(docs: pa.Table, sizes: pa.Table) -> pa.Table:
        ids, n_bytes, n_tokens = [], [], []
        sized = sizes.column("sized").combine_chunks().flatten().to_numpy()
        size = np.zeros(len(sized), np.int64)
        size[sized >> 32] = sized & 0xFFFFFFFF
        for row in docs.to_pylist():
            step, count = unpack(row["pairs"])
            ends = np.array(row["ends"], np.int64)
            first = np.concatenate([[0], ends[:-1]])
            run = np.cumsum(step, dtype=np.int64)  # places, plus what came before the document
            before = np.where(first > 0, run[first - 1], 0) if len(run) else np.zeros(len(ends), np.int64)
            place = run - np.repeat(before, ends - first)
            sums = np.concatenate([[0], np.cumsum(size[place] * count)])
            ids += row["ids"]
            n_bytes += row["n_bytes"]
            n_tokens.append(sums[ends] - sums[first] + np.array(row["added"], np.int64))
        return pa.table({id_col: pa.array(ids, pa.int64()), "n_bytes": pa.array(n_bytes, pa.int64()),
                         "n_tokens": pa.array(np.concatenate(n_tokens or [np.empty(0, np.int64)]), pa.int64())})

    docs = cut.drop("pre_tokens")
    return docs.groupBy("slice").cogroup(sized.groupBy("of")).applyInArrow(
        total, f"{id_col} long, n_bytes long, n_tokens long")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens, and whether it is over the limit."""
    counts = count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
