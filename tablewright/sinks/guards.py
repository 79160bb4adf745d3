"""Checks run on the driver before a write deletes anything.

* ``assert_not_reading`` — an overwrite whose target is also read by the
  plan would delete its own input (a CSV job then fails half-way, a JDBC
  overwrite leaves an empty table).  Refused up front.
* ``positional_diff`` — inserts pair columns by position.  Spark rejects
  some mismatches (text into decimal, too few columns) but silently accepts
  reordered columns of compatible types and rounds away excess decimal
  scale.  The diff lists every such pairing so the job can refuse it.
"""

from __future__ import annotations

import os
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tablewright.errors import SelfOverwriteError
from tablewright.session import spark_context

# Decimal digits of the largest value of each integral type
# (127, 32767, 2147483647, 9223372036854775807).
_INT_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified path (scheme and authority), without trailing slash."""
    sc = spark_context(spark)
    if sc is None:  # Spark Connect: no JVM access; normalise the text
        return _canon(path if urlsplit(path).scheme else "file:" + os.path.abspath(path))
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString().rstrip("/")


def _exists(spark: SparkSession, path: str) -> bool:
    sc = spark_context(spark)
    if sc is None:
        return True  # cannot tell: check as if it existed
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p))


def _canon(uri: str) -> str:
    """``file:/x``, ``file:///x`` and ``file://x/`` spelled one way."""
    parts = urlsplit(uri)
    return f"{parts.scheme}://{parts.netloc}{unquote(parts.path)}".rstrip("/")


def overlaps(a: str, b: str) -> bool:
    a, b = _canon(a), _canon(b)
    return a == b or a.startswith(b + "/") or b.startswith(a + "/")


def plan_roots(df: DataFrame) -> list[str]:
    """Root paths of the file and table relations that ``df`` reads."""
    if spark_context(df.sparkSession) is None:  # Spark Connect: no access to the plan
        return df.inputFiles()
    plan = df._jdf.queryExecution().analyzed()
    plans = [plan]
    below = plan.subqueriesAll()
    plans += [below.apply(i) for i in range(below.size())]
    roots = []
    for p in plans:
        leaves = p.collectLeaves()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            kind = leaf.getClass().getSimpleName()
            if kind == "HiveTableRelation":
                roots.append(leaf.tableMeta().location().toString())
            elif kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
                paths = leaf.relation().location().rootPaths()
                roots += [paths.apply(k).toString() for k in range(paths.size())]
    return roots


def assert_not_reading(spark: SparkSession, df: DataFrame | None, target: str,
                       sources: list[str] = ()) -> None:
    """Refuse when ``target`` is, contains, or lies inside a source location.

    ``sources`` are locations the job knows it reads; the root folders of the
    plan's file relations are checked too (a few paths a relation, however
    many files it has).  A target that does not exist yet cannot be
    overwritten, so then nothing is looked at (one metadata call).
    """
    tgt = qualify(spark, target)
    if not _exists(spark, tgt):
        return  # nothing there to delete
    for s in sources:
        if overlaps(qualify(spark, s), tgt):
            raise SelfOverwriteError(f"refusing to overwrite {tgt}: it is read by this job ({s})")
    if df is not None:
        for root in plan_roots(df):
            if overlaps(qualify(spark, root), tgt):
                raise SelfOverwriteError(f"refusing to overwrite {tgt}: the data being written reads {root}")


def _widens(src: DataType, dst: DataType) -> str | None:
    """None if every ``src`` value fits ``dst`` unchanged, else the reason."""
    if src == dst:
        return None
    if isinstance(dst, StringType):
        return None if not isinstance(src, StructType) else "struct into string"
    if isinstance(src, StringType):
        return "text into a typed column (parse may fail or give null)"
    if type(src) in _INT_DIGITS and type(dst) in _INT_DIGITS:
        return None if _INT_DIGITS[type(src)] <= _INT_DIGITS[type(dst)] else "integer narrowed"
    if type(src) in _INT_DIGITS and isinstance(dst, DecimalType):
        need = _INT_DIGITS[type(src)]
        return None if dst.precision - dst.scale >= need else "integer digits exceed the decimal"
    if isinstance(src, DecimalType) and isinstance(dst, DecimalType):
        if src.scale > dst.scale:
            return f"scale {src.scale} rounded to {dst.scale}"
        if src.precision - src.scale > dst.precision - dst.scale:
            return "integer digits may overflow"
        return None
    if isinstance(src, FloatType) and isinstance(dst, DoubleType):
        return None
    if type(src) in _INT_DIGITS and isinstance(dst, (FloatType, DoubleType)):
        # exact while the integer fits the mantissa (24 / 53 bits)
        exact = {FloatType: (ByteType, ShortType), DoubleType: (ByteType, ShortType, IntegerType)}
        return None if type(src) in exact[type(dst)] else "integer may lose precision as floating point"
    if isinstance(src, DateType) and isinstance(dst, (TimestampType, TimestampNTZType)):
        return None
    if isinstance(src, (TimestampType, TimestampNTZType)) and isinstance(dst, (TimestampType, TimestampNTZType)):
        return "time-zone interpretation changes"
    return f"{src.simpleString()} does not convert losslessly"


def positional_diff(source: StructType, target: StructType, *, match_names: bool = True) -> list[str]:
    """Every problem with inserting ``source`` into ``target`` by position."""
    diff = []
    if len(source.fields) != len(target.fields):
        diff.append(f"arity: source has {len(source.fields)} columns, target {len(target.fields)}")
    for i, (s, t) in enumerate(zip(source.fields, target.fields), start=1):
        if match_names and s.name.lower() != t.name.lower():
            diff.append(f"#{i}: source `{s.name}` lands in target `{t.name}`")
        why = _widens(s.dataType, t.dataType)
        if why:
            diff.append(f"#{i} `{t.name}`: {s.dataType.simpleString()} -> "
                        f"{t.dataType.simpleString()}: {why}")
    return diff
