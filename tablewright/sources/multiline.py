"""CSV files whose quoted values hold line breaks, read by many tasks a file.

Spark cannot split such a file, because a byte offset does not tell whether it
lies inside quotes.  Quote parity does: a line begins a record exactly if the
quotes before it, from the start of the file, are even in number.  So

1. one pass counts the quotes of every split (an aggregate, one row a split);
2. a running sum over a file's splits says which of them begin inside quotes;
3. a second pass, told that much, joins lines to records within its split,
   and hands over the pieces of records that cross a split's end;
4. the pieces, at most two a split, are put together in file order.

The records are written once to the shared folder: what a split holds depends
on settings that may change between two runs of a plan, and a row read twice
would be parsed twice.  Parsing is Spark's own (``from_csv``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablewright.errors import TableJobError
from tablewright.functions.text import csv_options
from tablewright.session import write_once
from tablewright.sources.csv import read_csv_header, read_csv_positional

WHOLE, BEGIN, MIDDLE, END = 0, 1, 2, 3  # a record, or which piece of one
RECORDS = "record string, file string, start long, piece int, first boolean"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines in file order within a split, with their file and split."""
    return spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _quotes(text):
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def split_parity(lines: DataFrame) -> DataFrame:
    """``file``, ``start``, ``inside`` (does the split begin inside quotes?)
    and ``after`` (does it end so?); a row a split that holds a line's start."""
    counts = lines.groupBy("file", "start").agg(F.sum(_quotes("value")).alias("quotes"))
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("quotes").over(upto)
    return write_once(counts.select("file", "start", ((total - F.col("quotes")) % 2 == 1).alias("inside"),
                                    (total % 2 == 1).alias("after")), "quote-parity")


class _Split:
    """The records of one split, its lines given in order."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start = file, start
        self.odd = self.headless = inside
        self.open: list[str] = []  # lines of the record that is not complete
        self.seen = False

    def lines(self, lines: list[str], quotes: np.ndarray):
        """Rows for the records that end in ``lines``."""
        odd = (self.odd + np.cumsum(quotes)) % 2
        ends = np.flatnonzero(odd == 0)
        begin = 0
        for end in ends.tolist():
            text = lines[end] if begin == end else "\n".join(lines[begin : end + 1])
            if self.open:
                text = "\n".join([*self.open, text])
                self.open = []
            yield self._row(text, END if self.headless else WHOLE)
            self.headless = False
            begin = end + 1
        self.open += lines[begin:]
        self.odd = int(odd[-1])

    def rest(self):
        if self.open:
            yield self._row("\n".join(self.open), MIDDLE if self.headless else BEGIN)

    def _row(self, text: str, piece: int):
        first = self.start == 0 and not self.seen
        self.seen = True
        return text, self.file if piece or first else None, self.start, piece, first


def _records(batches):
    """Arrow batches of ``value``, ``file``, ``start``, ``inside`` to ``RECORDS``."""
    split: _Split | None = None
    for batch in batches:
        value, file, start, inside = (batch.column(i) for i in range(4))
        if inside.null_count:
            raise ValueError("the splits of a CSV file changed between two passes over it; read it again")
        quotes = pc.count_substring(value, '"').to_numpy().astype(np.int64)
        at, code = start.to_numpy(), file.dictionary_encode().indices.to_numpy()
        new = np.flatnonzero((at[1:] != at[:-1]) | (code[1:] != code[:-1])) + 1
        text = value.to_pylist()
        rows: list[tuple] = []
        for a, b in zip([0, *new.tolist()], [*new.tolist(), len(text)]):
            here = (file[a].as_py(), int(at[a]))
            if split is None or (split.file, split.start) != here:
                if split is not None:
                    rows += split.rest()
                split = _Split(*here, inside[a].as_py())
            rows += split.lines(text[a:b], quotes[a:b])
        yield _batch(rows)
    if split is not None:
        yield _batch(list(split.rest()))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_()]
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      names=["record", "file", "start", "piece", "first"])


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``record`` (text with its line breaks) and ``first`` (is it its file's first?)."""
    lines = _lines(spark, path)
    splits = split_parity(lines)
    last = F.max(F.struct("start", "after"))["after"]
    torn = splits.groupBy("file").agg(last.alias("open")).where("open").limit(1).collect()
    if torn:
        raise TableJobError(f"{torn[0].file}: the quotes do not pair up, so records cannot be told apart")
    # one row a split: bounded by the number of input splits
    known = F.broadcast(splits.select("file", "start", "inside"))
    told = lines.join(known, ["file", "start"], "left").select("value", "file", "start", "inside")
    found = write_once(told.mapInArrow(_records, RECORDS), "csv-records")
    # pieces: a record begins once; what follows until the next one begins is its own
    order = Window.partitionBy("file").orderBy("start", F.col("piece") == BEGIN)
    pieces = found.where(F.col("piece") != WHOLE).withColumn(
        "n", F.sum((F.col("piece") == BEGIN).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = pieces.groupBy("file", "n").agg(
        F.sort_array(F.collect_list(F.struct("start", "record"))).alias("parts"), F.max("first").alias("first"))
    joined = joined.select(F.concat_ws("\n", F.transform("parts", lambda p: p["record"])).alias("record"), "first")
    return found.where(F.col("piece") == WHOLE).select("record", "first").unionByName(joined)


def read_csv_multiline(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, *,
                       header: bool = False, sep: str = ",", null_value: str | None = None) -> DataFrame:
    """RFC-4180 CSV (quotes doubled inside quotes) whose quoted values may
    hold line breaks; a large file is read by as many tasks as it has splits.

    Without ``schema`` all columns are strings, named by the header or
    ``_c0 …``.  With ``header`` every file's first record must hold the
    column names, or the read fails.  Line breaks inside quotes are kept as
    they are; records may end in ``\\n`` or ``\\r\\n``.  Empty lines are no
    records; short records are padded with null, long ones cut.  A file whose
    quotes do not pair up is refused, since a quote inside an unquoted value
    would shift all that follows.  An empty file gives no rows.
    """
    if schema is None:
        found = read_csv_header(spark, path, multiline=True) if header else read_csv_positional(spark, path, multiline=True)
        schema = StructType([StructField(n, StringType()) for n in found.columns])
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    options = csv_options(sep, null_value, line_sep="\n") | {"multiLine": "true"}
    options.pop("header")

    def parsed(fields):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        return F.from_csv(F.col("record"), ddl, options)

    text = F.regexp_replace("record", "\r$", "")
    rows = records(spark, path).select(
        F.when(F.col("first"), F.regexp_replace(text, "^\ufeff", "")).otherwise(text).alias("record"), "first")
    rows = rows.where(F.col("record") != "")
    if header:
        names = F.array(*[parsed([StructField(f.name, StringType()) for f in schema.fields])[f.name] for f in schema.fields])
        same = names == F.array(*[F.lit(f.name) for f in schema.fields])
        rows = rows.where(F.when(~F.col("first"), F.lit(True)).when(same, F.lit(False)).otherwise(
            F.raise_error(F.concat(F.lit("CSV header does not conform to the schema: "), "record")).cast("boolean")))
    return rows.select(F.inline(F.array(parsed(schema.fields))))
