"""Profile of text columns: the narrowest type each could be stored as.

A value of a text column fits some of the types of a small lattice (an
integer fits every wider number, a date every timestamp, everything a
string).  The types a value fits are bits of one number, and what a column
fits is the bitwise *and* over its values, so the answer folds in any order
and merges across tasks; a decimal's precision comes from the most digits
before and the most behind the point.  One aggregate gives all columns, with
nulls, lengths, least and greatest values and a mergeable sketch
(HyperLogLog) of the number of distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablewright.errors import CapabilityError

#: Types from narrow to wide, and the bit of each.
TYPES = ["boolean", "int", "bigint", "decimal", "double", "date", "timestamp"]
BIT = {t: 1 << i for i, t in enumerate(TYPES)}
INTEGER = r"^-?(0|[1-9][0-9]*)$"
DECIMAL = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
MAX_DIGITS = 38
SKETCH = 12  # 2**12 registers: a standard error of about 1.6 %


def _shapes(value: Column, number: Column) -> tuple[Column, Column]:
    """Is ``value`` an integer, a decimal?  A number without an exponent is a
    decimal, a decimal without a point an integer: one pattern tells all three."""
    decimal = number & ~value.contains("e") & ~value.contains("E")
    return decimal & ~value.contains("."), decimal


def fits(value: Column, number: Column | None = None) -> Column:
    """The bits of the types that ``value`` (not null) can be stored as
    without loss: numbers have no leading zeros, dates and timestamps exist.

    Only values of a type's possible lengths (and a line end, which the patterns
    let pass) are tried as that type, and no number as a date or timestamp.
    ``number`` is ``value.rlike(NUMBER)``, if the caller has it already.
    """
    number = value.rlike(NUMBER) if number is None else number
    integer, decimal = _shapes(value, number)
    size = F.length(value)
    big = value.try_cast("bigint")
    date = size.between(10, 12) & value.rlike(DATE) & value.try_cast("date").isNotNull()
    moment = size.between(19, 28) & value.rlike(TIMESTAMP) & value.try_cast("timestamp_ntz").isNotNull()
    bit = {t: F.lit(b) for t, b in BIT.items()}
    whole = (F.when(big.between(-(1 << 31), (1 << 31) - 1), F.lit(BIT["int"] | BIT["bigint"]))
             .when(big.isNotNull(), bit["bigint"]).otherwise(F.lit(0)))
    of_number = (F.when(decimal, bit["decimal"]).otherwise(F.lit(0))
                 + F.when(value.try_cast("double").isNotNull(), bit["double"]).otherwise(F.lit(0))
                 + F.when(integer, whole).otherwise(F.lit(0)))
    return (F.when(number, of_number)
            .when(size.between(4, 5) & F.lower(value).isin("true", "false"), bit["boolean"])
            .when(date, F.lit(BIT["date"] | BIT["timestamp"])).when(moment, bit["timestamp"]).otherwise(F.lit(0)))


def _digits(value: Column, number: Column) -> tuple[Column, Column]:
    """Digits before and behind the point of a decimal."""
    _, decimal = _shapes(value, number)
    sign, point, size = value.startswith("-").cast("int"), F.instr(value, "."), F.length(value)
    return (F.when(decimal, F.when(point > 0, point - 1 - sign).otherwise(size - sign)),
            F.when(decimal, F.when(point > 0, size - point).otherwise(0)))


def narrowest(bits: Column, whole: Column, scale: Column) -> Column:
    """The name of the narrowest type in ``bits`` (null: no values at all)."""
    short = whole + scale <= MAX_DIGITS
    out = F.when(bits.isNull(), F.lit("void"))
    for name in TYPES:
        has = bits.bitwiseAND(F.lit(BIT[name])) != 0
        if name == "decimal":
            out = out.when(has & short, F.format_string("decimal(%d,%d)", whole + scale, scale))
        else:
            out = out.when(has, F.lit(name))
    return out.otherwise(F.lit("string"))


def profile(df: DataFrame) -> DataFrame:
    """One row per column of ``df`` (all text): ``ordinal``, ``name``,
    ``type`` (narrowest), ``rows``, ``nulls``, ``min_text``, ``max_text``,
    ``min_number``, ``max_number`` (numeric types only), ``longest`` (code
    points) and ``distinct`` (estimated).

    Folded in one aggregate; the result is one small row however large the
    table.  A column of nulls only, or an empty table, has type ``void``.
    """
    other = [f.name for f in df.schema.fields if not isinstance(f.dataType, StringType)]
    if other:
        raise CapabilityError(f"profile reads text columns; not text: {', '.join(other)}")
    # the number a value is, once a value, in a projection of its own; the tests that need it stay in the aggregates,
    # which Spark compiles in parts: side by side in one projection they outgrow what the JVM compiles
    values, aggregates = [], [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(df.columns):
        c, number = F.col(f"v{i}"), F.col(f"number{i}")
        value = F.col(f"`{name}`")
        values += [value.alias(f"v{i}"), F.when(value.rlike(NUMBER), value.try_cast("double")).alias(f"number{i}")]
        whole, scale = _digits(c, number.isNotNull())
        aggregates.append(F.struct(
            F.bit_and(F.when(c.isNotNull(), fits(c, number.isNotNull()))).alias("bits"), F.max(whole).alias("whole"),
            F.max(scale).alias("scale"), F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"),
            F.min(number).alias("low"), F.max(number).alias("high"), F.max(F.length(c)).alias("longest"),
            F.hll_sketch_agg(c, F.lit(SKETCH)).alias("sketch")).alias(f"c{i}"))
    folded = df.select(*values).agg(*aggregates)
    rows = []
    for i, name in enumerate(df.columns):
        c = F.col(f"c{i}")
        kind = narrowest(c["bits"], c["whole"], c["scale"])
        numeric = c["bits"].bitwiseAND(F.lit(BIT["double"])) != 0
        rows.append(F.struct(
            F.lit(i + 1).alias("ordinal"), F.lit(name).alias("name"), kind.alias("type"), F.col("rows"),
            (F.col("rows") - c["n"]).alias("nulls"), c["lo"].alias("min_text"), c["hi"].alias("max_text"),
            F.when(numeric, c["low"]).alias("min_number"), F.when(numeric, c["high"]).alias("max_number"),
            c["longest"].cast("long").alias("longest"),
            F.coalesce(F.hll_sketch_estimate(c["sketch"]), F.lit(0)).cast("long").alias("distinct")))
    return folded.select(F.inline(F.array(*rows)))
