"""Exact byte-pair encoding and decoding.

Encoding finds the tokens of a word without replaying the merges.  An
Aho-Corasick automaton over the vocabulary gives, for every place of the
word, the longest token that starts there.  Tokens are taken left to right;
a token may follow another only if the two are *compatible*: merging their
concatenation from scratch would leave exactly these two.  Where the longest
token is not compatible its longest proper prefix that is a token is tried,
and where none is left the encoder steps back one token and never visits
that place again, so each place is entered once: linear time.  By the
prefix property of byte-pair merges, the sequence whose neighbours are all
compatible is unique and equals the result of the merges.

Compatibility of a pair is decided by undoing merges along the seam, from
the latest to the earliest: the pair fails as soon as two tokens that meet
at the seam would have merged before the merges that built them.  Decisions
are kept in a pair table of bounded size.

Decoding reads an offset table: token ``i`` is the bytes
``blob[offsets[i]:offsets[i + 1]]`` of one array, so a batch of ids becomes
text by index arithmetic.

The vocabulary file is the JSON of the ``tokenizers`` library, read from a
path on the driver (a parameter; about 2 MB) and shipped to the tasks in the
closure.  Supported: BPE models with an end-of-word suffix over byte-level
symbols, NFC and lower-casing normalisers, a split by pattern, added tokens
that match on the raw text.  Anything else is refused by name.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.errors import CapabilityError
from tablewright.llm.common import kept_by_worker, map_texts, read_table, text_or_empty

PAIR_TABLE = 1 << 18  # decisions kept per task
WORD_TABLE = 1 << 18  # encoded words kept per task, twice
WORD_TABLE_CHARS = 64  # longer words are encoded anew each time

# The byte-level alphabet (printable bytes stand for themselves,
# the others for the code points from 256 on, in byte order).
PRINTABLE = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]
CONTROL = "\x1c\x1d\x1e\x1f"  # white space for Python, not for the pre-tokenizer
# The pre-tokenizer's white space.
WHITE_SPACE = r"\t-\r\x20\x85\xa0  -     　"


def byte_symbols() -> list[str]:
    out, extra = [], 0
    for b in range(256):
        if any(lo <= b <= hi for lo, hi in PRINTABLE):
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


def read_vocabulary(path: str) -> dict:
    """The parts of a tokenizer file that encoding and decoding need."""
    with open(path, "rb") as f:
        raw = f.read()
    spec = json.loads(raw)
    model = spec["model"]
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    ok = (model["type"] == "BPE" and not model.get("dropout") and model.get("end_of_word_suffix")
          and steps == ["NFC", "Replace", "Lowercase"] and spec["decoder"] is None
          and [p["type"] for p in pre] == ["Split", "ByteLevel"] and pre[0]["behavior"] == "Removed"
          and pre[0]["invert"] and all(not t["normalized"] for t in spec["added_tokens"]))
    if not ok:
        raise CapabilityError(f"{path}: only byte-level BPE with a word-end suffix, NFC + white space + lower case, "
                              "and a pattern split is supported")
    return {"key": hashlib.sha256(raw).hexdigest(), "vocab": model["vocab"], "merges": [tuple(m) for m in model["merges"]],
            "suffix": model["end_of_word_suffix"], "pattern": pre[0]["pattern"]["Regex"],
            "added": {t["content"]: t["id"] for t in spec["added_tokens"]}}


class WordTable(dict):
    """Encoded words, newest two generations of at most ``WORD_TABLE`` each."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        got = self.old.get(word)
        if got is None:
            got = self.encode(word)
        if len(word) <= WORD_TABLE_CHARS:
            if len(self) >= WORD_TABLE:
                self.old = dict(self)
                self.clear()
            self[word] = got
        return got


class Encoder:
    """Text to token ids; its tables are bounded."""

    def __init__(self, voc: dict):
        import ahocorasick
        import regex

        # the last symbol of a word carries the suffix: a second alphabet
        self.final = 0x10000
        suffix, ids = voc["suffix"], voc["vocab"]
        symbols = byte_symbols()
        self.symbols = {b: symbols[b] for b in range(256)}
        self.last = {c: chr(self.final + ord(c)) for c in symbols}
        spelled = {}
        for token, i in ids.items():
            if token.endswith(suffix) and len(token) > len(suffix):
                body = token[: -len(suffix)]
                token = body[:-1] + chr(self.final + ord(body[-1]))
            spelled[token] = i
        self.length = [0] * (max(spelled.values()) + 1)
        for t, i in spelled.items():
            self.length[i] = len(t)
        self.auto = ahocorasick.Automaton()
        for t, i in spelled.items():
            self.auto.add_word(t, i)
        self.auto.make_automaton()
        self.shorter: list[int | None] = [None] * len(self.length)  # token -> its longest proper prefix that is a token
        for t, i in spelled.items():
            self.shorter[i] = next((spelled[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in spelled), None)
        self.rank, self.parts = {}, {}
        for r, (a, b) in enumerate(voc["merges"]):
            pair = (ids[a], ids[b])
            self.rank[pair] = r
            self.parts[ids[a + b]] = (*pair, r)
        self.pairs: dict[int, int] = {}  # last token and longest match -> the token that follows
        self.split = regex.compile(voc["pattern"].replace(r"\s", WHITE_SPACE))
        self.spaces = regex.compile("[" + WHITE_SPACE + "]+")
        self.added = voc["added"]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.words = WordTable(self._run)

    def _compatible(self, left: int, right: int) -> bool:
        """Would the merges, run over both tokens' symbols, leave the two?"""
        limit = len(self.rank)
        a, b = left, right
        while True:
            r = self.rank.get((a, b))
            if r is not None and r < limit:
                return False
            of_a, of_b = self.parts.get(a), self.parts.get(b)
            if of_a is None and of_b is None:
                return True
            # undo the later merge of the two; for equal tokens the left one is built first
            if of_b is None or (of_a is not None and of_a[2] > of_b[2]):
                a, limit = of_a[1], of_a[2]
            else:
                b, limit = of_b[0], of_b[2] + 1

    def _follow(self, last: int, token: int) -> int:
        """The longest token that may follow ``last``: ``token`` or a prefix of it; -1: none."""
        pick = token
        while pick is not None and not self._compatible(last, pick):
            pick = self.shorter[pick]
        if len(self.pairs) >= PAIR_TABLE:
            self.pairs.clear()
        got = self.pairs[last << 20 | token] = -1 if pick is None else pick
        return got

    def word(self, text: str) -> list[int]:
        """Tokens of one pre-token (not empty)."""
        if not (text.isascii() and text.isalpha()):  # letters of ASCII stand for themselves
            text = text.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.symbols)
        spelled = text[:-1] + self.last[text[-1]]
        n, length, pairs, longest = len(spelled), self.length, self.pairs.get, self.auto.iter_long
        matches = longest(spelled)
        last = next(matches)[1]  # every symbol is a token: something starts everywhere
        out, at = [last], length[last]
        while at < n:
            token = next(matches)[1]
            pick = pairs(last << 20 | token)
            if pick is None:
                pick = self._follow(last, token)
            if pick < 0:
                return self._stepping_back(spelled, out, at)
            out.append(pick)
            at += length[pick]
            if pick != token:
                matches = longest(spelled, at)
            last = pick
        return out

    def _stepping_back(self, spelled: str, out: list[int], at: int) -> list[int]:
        """Goes on where no token can follow: back one token, never to ``at`` again."""
        n, length, shorter, pairs, longest = len(spelled), self.length, self.shorter, self.pairs.get, self.auto.iter_long
        closed = {at}
        token = out.pop()
        at -= length[token]
        last = out[-1] if out else -1
        token = shorter[token]
        while True:
            while token is not None:
                if last >= 0:
                    pick = pairs(last << 20 | token)
                    token = self._follow(last, token) if pick is None else pick
                    if token < 0:
                        token = None
                        break
                if at + length[token] not in closed:
                    break
                token = shorter[token]
            if token is not None:
                out.append(token)
                last = token
                at += length[token]
                if at == n:
                    return out
                token = next(longest(spelled, at))[1]
            else:
                closed.add(at)
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1
                token = shorter[token]

    def _run(self, text: str) -> bytes:
        """Ids (int32) of a text without white space."""
        if text.isalpha():
            return array("i", self.word(text)).tobytes()
        if text[-1] in ".," and text[:-1].isalpha():  # most words before a stop are known already
            return self.words[text[:-1]] + self.words[text[-1]]
        pieces = self.split.findall(text)
        if pieces == [text]:
            return array("i", self.word(text)).tobytes()
        return b"".join(map(self.words.__getitem__, pieces))  # most pieces are known already

    def _plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # the lower case of sigma does not depend on its place here
            text = text.replace("Σ", "σ")
        text = text.lower()
        # no pre-token spans white space; Python's own split also cuts at four control characters
        plain = not any(c in text for c in CONTROL)
        runs = text.split() if plain else [w for w in self.spaces.split(text) if w]
        return b"".join(map(self.words.__getitem__, runs))

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text`` as int32."""
        if not any(t in text for t in self.added):
            return np.frombuffer(self._plain(text), np.int32)
        out = [np.int32(self.added[part]).tobytes() if part in self.added else self._plain(part)
               for part in self.cut.split(text)]
        return np.frombuffer(b"".join(out), np.int32)


def encoder(voc: dict) -> Encoder:
    """The encoder of this worker process: its tables serve task after task."""
    return kept_by_worker(("encoder", voc["key"]), lambda: Encoder(voc))


class Decoder:
    """Ids to text by an offset table (tokens joined by one space)."""

    CHUNK = 1 << 18

    def __init__(self, voc: dict):
        tokens = {i: t for t, i in voc["vocab"].items()} | {i: t for t, i in voc["added"].items()}
        spelled = [(tokens.get(i, "") + " ").encode() for i in range(max(tokens) + 1)]
        self.blob = np.frombuffer(b"".join(spelled), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(s) for s in spelled])]).astype(np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text of ``ids``."""
        out = []
        for k in range(0, len(ids), self.CHUNK):
            part = ids[k : k + self.CHUNK]
            start = self.offsets[part]
            size = self.offsets[part + 1] - start
            ends = np.cumsum(size, dtype=np.int32)
            place = np.repeat(start - ends + size, size)
            place += np.arange(len(place), dtype=np.int32)
            out.append(self.blob[place].tobytes())
        return b"".join(out)[:-1]


def id_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))


def bpe_encode(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (array<int>): the tokens of every whole text.

    A null text counts as empty and has no tokens; repeated rows come out as
    often as they came in; a null id stays null; other columns are dropped.
    """
    voc = read_vocabulary(vocabulary)
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col))

    def work():
        enc = encoder(voc)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [enc.encode(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), id_lists(ids)], names=[id_col, "ids"])
        return run

    return map_texts(src, f"{id_col} long, ids array<int>", work, keeps=True)


def bpe_decode(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``ids_col``, ``text``: ids back to text, special tokens kept.

    Null or empty ids give the empty text; ids outside the vocabulary raise.
    """
    voc = read_vocabulary(vocabulary)
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        dec = Decoder(voc)
        for batch in batches:
            step = 256  # rows at a time: the text of a few rows, not of the batch
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                ids = (np.array(v.as_py() or [], np.int32) for v in part.column(1))
                texts = [dec.decode(x).decode() if len(x) else "" for x in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 names=[id_col, ids_col, "text"])

    return src.mapInArrow(run, f"{id_col} long, {ids_col} array<int>, text string")


def bpe_round_trip(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids``, ``decoded``: both directions in one pass over the
    texts, so that the ids cross to Spark once."""
    voc = read_vocabulary(vocabulary)
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col))

    def work():
        enc, dec = encoder(voc), Decoder(voc)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [enc.encode(t) for t in batch.column(1).to_pylist()]
            texts = [dec.decode(x).decode() if len(x) else "" for x in ids]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), id_lists(ids), pa.array(texts, pa.string())], names=[id_col, "ids", "decoded"])
        return run

    return map_texts(src, f"{id_col} long, ids array<int>, decoded string", work, keeps=True)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    both = bpe_round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
