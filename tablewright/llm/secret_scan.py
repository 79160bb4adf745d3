"""Secrets in texts: fixed patterns, and random strings by token efficiency.

A vocabulary learned from text spells words in few, long tokens; a random
key falls apart into tokens of one or two characters.  Every run of key
characters with a letter in it, 20 or more long, is tokenised, and is
reported if it has fewer than ``max_ratio`` characters per token.  In other
runs a key may be joined to words: the pieces between / = _ - are tested, and
the stretches of short tokens, wherever they stand.  A stretch is reported with
the pieces it touches if those pass the test, else as it is.  Known
digests (hexadecimal strings of the common digest lengths) and identifiers
(UUIDs, plain numbers) are random too but no secrets; they are left out, as
is what a fixed pattern has reported already.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.bpe import tokenizer_path
from tablewright.llm.common import kept_by_worker, map_texts, read_table, text_or_empty

# Fixed patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more: what is left of [0-9a-f]+ once shorter ones are dropped
MIN_VALUE, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]

RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})\Z")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
PIECE = re.compile(r"[^/=_-]+")
KNOWN = re.compile(rf"(?<![A-Za-z0-9+])(?:{UUID.pattern[:-2]}|{DIGEST.pattern[:-2]})(?![A-Za-z0-9+])")
LETTER = re.compile("[A-Za-z]")
MIN_RUN = 20
MAX_RATIO = 2.0
MASK = "[secret]"


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _dense(lengths: list[int], ratio: float) -> list[tuple[int, int]]:
    """The maximal stretches (from, to) of tokens with fewer than ``ratio``
    characters each on average (maximal scoring segments, linear)."""
    found: list[list] = []  # from, to, score before, score with
    total = 0.0
    for i, n in enumerate(lengths):
        before, total = total, total + ratio - n
        if n >= ratio:
            continue
        new = [i, i + 1, before, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(a, b) for a, b, _, _ in found]


class Scanner:
    """``spans(text)``: (start, kind number, end) in order."""

    def __init__(self, ranks: bytes, pattern: str, max_ratio: float):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        self.tokens = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                                        mergeable_ranks={base64.b64decode(t): int(r) for t, r in pairs})
        self.max_ratio = max_ratio

    def random(self, run: str) -> bool:
        if not LETTER.search(run) or DIGEST.match(run) or UUID.match(run):
            return False
        return len(run) < self.max_ratio * len(self.tokens.encode_ordinary(run))

    def joined(self, run: str) -> list[tuple[int, int]]:
        """Random pieces and stretches of a run that is not random as a whole."""
        out = [m.span() for m in PIECE.finditer(run) if len(m[0]) >= MIN_RUN and self.random(m[0])]
        ends = [0]
        for t in self.tokens.encode_ordinary(run):
            ends.append(ends[-1] + len(self.tokens.decode_single_token_bytes(t)))
        pieces = None
        for i, j in _dense([b - a for a, b in zip(ends, ends[1:])], self.max_ratio):
            a, b = ends[i], ends[j]
            if pieces is None:
                pieces = [m.span() for m in PIECE.finditer(run)]
                starts, stops = [p[0] for p in pieces], [p[1] for p in pieces]
            first, last = bisect.bisect_right(stops, a), bisect.bisect_left(starts, b) - 1
            if first > last:
                continue
            whole = (starts[first], stops[last])
            if whole[1] - whole[0] >= MIN_RUN and self.random(run[slice(*whole)]):
                out.append(whole)
            elif b - a >= MIN_RUN and self.random(run[a:b]):
                out.append((a, b))
        return _merged(out)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        out = []
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        base = _merged([(a, b) for a, _, b in out])
        at = 0
        for m in RUN.finditer(text):
            a, b = m.span()
            while at < len(base) and base[at][1] <= a:
                at += 1
            over = at
            while over < len(base) and base[over][0] < b:
                over += 1
            taken = base[at:over]
            if not taken and self.random(m[0]):
                out.append((a, 3, b))
                continue
            if DIGEST.match(m[0]) or UUID.match(m[0]):
                continue
            # what lies between reported spans, digests and identifiers
            taken = _merged(taken + [(a + k.start(), a + k.end()) for k in KNOWN.finditer(m[0])])
            for x, y in zip([a, *(y for _, y in taken)], [*(x for x, _ in taken), b]):
                if y - x >= MIN_RUN:
                    part = text[x:y]
                    if self.random(part):
                        out.append((x, 3, y))
                    else:
                        out += [(x + i, 3, x + j) for i, j in self.joined(part)]
        out.sort()
        return out


def _scanner(ranks: bytes, pattern: str, max_ratio: float) -> Scanner:
    key = ("scanner", hashlib.sha256(ranks).hexdigest(), max_ratio)
    return kept_by_worker(key, lambda: Scanner(ranks, pattern, max_ratio))


def _settings(ranks_path: str) -> tuple[bytes, str]:
    import public_tokenizers

    with open(ranks_path, "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def scan_secrets(df: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 max_ratio: float = MAX_RATIO) -> DataFrame:
    """``id_col``, ``spans``: array of (kind, start, end) of every whole text,
    by start, then kind as listed; code points, end exclusive.

    A null text counts as empty and has no spans; repeated rows come out as
    often as they came in; a null id stays null; other columns are dropped.
    """
    ranks, pattern = _settings(ranks_path)
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col))

    def work():
        scanner = _scanner(ranks, pattern, max_ratio)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scanner.spans(t)]
                     for t in batch.column(1).to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=[id_col, "spans"])
        return run

    return map_texts(src, f"{id_col} long, spans array<struct<kind:string,start:long,end:long>>", work, keeps=True)


def mask_secrets(df: DataFrame, ranks_path: str, *, text_col: str = "text", mask: str = MASK,
                 max_ratio: float = MAX_RATIO) -> DataFrame:
    """``df`` with every span of ``text_col`` replaced by ``mask``; spans that
    touch or overlap become one.

    A null text stays null, an empty one empty; repeated rows are masked
    alike; all other columns pass through whatever their names; an empty table
    gives no rows."""
    ranks, pattern = _settings(ranks_path)
    place = df.columns.index(text_col)

    def work():
        scanner = _scanner(ranks, pattern, max_ratio)

        def clean(text: str | None) -> str | None:
            spans = scanner.spans(text) if text else []
            if not spans:
                return text
            out, at = [], 0
            for a, _, b in spans:
                if a >= at:
                    if a > at or not out:
                        out.append(text[at:a])
                        out.append(mask)
                at = max(at, b)
            return "".join([*out, text[at:]])

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = pa.array([clean(t) for t in batch.column(place).to_pylist()], batch.column(place).type)
            return batch.set_column(place, batch.schema.field(place), texts)
        return run

    return map_texts(df, df.schema, work, place, keeps=True)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digests and lists of the secrets of every document."""
    found = scan_secrets(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))

    def listed(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *(count(k) for k in BASE_KINDS), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
