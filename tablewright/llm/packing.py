"""Packing token sequences into windows of a fixed length.

Online packing in bounded space.  Every partition keeps a fixed number of
open windows.  A document is cut into full windows, which are emitted at
once, and a rest.  The rest goes into the fullest open window that can take
all of it (best fit).  Where none can, the fullest window is topped up with
the first tokens of the rest and emitted, and what is left of the rest opens
a new window; so an emitted window holds no padding, and only documents that
fit nowhere are cut.

At the end the partition merges its own leftovers into full windows, which
leaves at most one open window, with fewer tokens than a window.  Those are
kept with their ids; groups of them (``MERGE`` partitions each, by partition
number) are merged by the same rule, and the last open window of a group is
closed as sequences whose lengths are powers of two, the binary digits of
its length, which need no padding.  State per task: the open windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.bpe import encoder, read_vocabulary, tokenizer_path
from tablewright.llm.common import keep_table, read_table, slices, text_or_empty

WINDOW = 4096
OPEN_WINDOWS = 32
MERGE = 64
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, part long, ids binary")
_NUMBERS = 40  # low bits of a sequence id: the number within its partition


class Packer:
    """Packs (doc_id, ids) of one partition; pieces come out in ``take()``.

    A window is a list of pieces ``(doc_id, start, ids, doc_tokens)``.
    """

    def __init__(self, window: int, open_windows: int, first_id: int):
        self.window, self.limit = window, open_windows
        self.open: list[tuple[int, list]] = []  # (tokens, pieces), fullest last
        self.next_id = first_id
        self.rows: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def _put(self, used: int, pieces: list) -> None:
        """An open window, at its place by fullness."""
        at = len(self.open)
        while at and self.open[at - 1][0] > used:
            at -= 1
        self.open.insert(at, (used, pieces))

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        w = self.window
        while len(ids) >= w:
            self._emit([(doc, start, ids[:w], total)])
            start, ids = start + w, ids[w:]
        need = len(ids)
        if not need:
            return
        for k in range(len(self.open) - 1, -1, -1):  # best fit: the fullest that can take it all
            used, pieces = self.open[k]
            if used + need <= w:
                del self.open[k]
                pieces.append((doc, start, ids, total))
                if used + need == w:
                    self._emit(pieces)
                else:
                    self._put(used + need, pieces)
                return
        if len(self.open) < self.limit:
            self._put(need, [(doc, start, ids, total)])
            return
        used, pieces = self.open.pop()
        room = w - used
        self._emit([*pieces, (doc, start, ids[:room], total)])
        self._put(need - room, [(doc, start + room, ids[room:], total)])

    def leftovers(self) -> list:
        """Merges the open windows; the pieces of the last, not full one."""
        left, self.open = self.open, []
        used, pieces = 0, []
        for _, more in reversed(left):
            for doc, start, ids, total in more:
                room = self.window - used
                if len(ids) < room:
                    pieces.append((doc, start, ids, total))
                    used += len(ids)
                else:
                    self._emit([*pieces, (doc, start, ids[:room], total)])
                    rest = ids[room:]
                    used, pieces = len(rest), [(doc, start + room, rest, total)] if len(rest) else []
        return pieces

    def close(self, pieces: list) -> None:
        """Ends a window as sequences of power-of-two lengths, longest first."""
        left = sum(len(p[2]) for p in pieces)
        queue = list(reversed(pieces))
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            out = []
            while room:
                doc, start, ids, total = queue.pop()
                if len(ids) > room:
                    queue.append((doc, start + room, ids[room:], total))
                    ids = ids[:room]
                out.append((doc, start, ids, total))
                room -= len(ids)
            self._emit(out)

    def take(self, part: int | None = None, left: list = ()) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        cols = [list(c) for c in zip(*rows)] if rows else [[] for _ in range(7)]
        part_col, ids_col = [None] * len(rows), [None] * len(rows)
        for doc, start, ids, total in left:
            for c, v in zip(cols, (doc, start, len(ids), zlib.crc32(ids.tobytes()), total, None, None)):
                c.append(v)
            part_col.append(part)
            ids_col.append(ids.tobytes())
        arrays = [pa.array(c, pa.int64()) for c in (*cols, part_col)] + [pa.array(ids_col, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in PIECES.split(", ")])


def pack_windows(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2, window: int = WINDOW, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``.

    Every document, also an empty or null one, ends with ``end_id`` and so
    has at least one token.  Repeated rows are packed as often as they come;
    a null id stays null; other columns are ignored; an empty table gives no
    piece.  Every token lies in exactly one piece, and the pieces of a
    sequence follow each other from offset 0 without a gap.  The ids are
    made once: pieces are written to the shared folder, where the merge of
    the leftovers reads them.
    """
    voc = read_vocabulary(vocabulary)
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc, packer = encoder(voc), Packer(window, open_windows, part << _NUMBERS)
        end = np.array([end_id], np.int32)
        for batch in batches:
            for piece in slices(batch, 1):
                for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    ids = np.concatenate([enc.encode(text), end]).astype("<i4", copy=False)
                    packer.add(doc, 0, ids, len(ids))
                yield packer.take()
        yield packer.take(part, packer.leftovers())

    first = keep_table(src.mapInArrow(pack, PIECES), "packed")

    def merge(key, table):
        packer = Packer(window, open_windows, (key[0].as_py() + 1 << _NUMBERS) - (1 << (_NUMBERS - 1)))
        table = table.sort_by([("part", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        for row in table.to_pylist():
            packer.open.append((row["length"], [(row["doc_id"], row["start"],
                                                 np.frombuffer(row["ids"], "<i4"), row["doc_tokens"])]))
        packer.close(packer.leftovers())
        return pa.Table.from_batches([packer.take()])

    merged = (first.where(F.col("part").isNotNull())
              .withColumn("merge_group", F.floor(F.col("part") / MERGE) * MERGE)
              .groupBy("merge_group").applyInArrow(merge, PIECES))
    return first.where(F.col("part").isNull()).unionByName(merged).drop("part", "ids")


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack_windows(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
