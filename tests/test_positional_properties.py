"""Property: every pairing ``positional_diff`` accepts keeps every value."""

import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from tablewright.sinks.guards import positional_diff

INTS = {ByteType(): 2**7, ShortType(): 2**15, IntegerType(): 2**31, LongType(): 2**63}


@st.composite
def decimal_types(draw):
    p = draw(st.integers(1, 38))
    return DecimalType(p, draw(st.integers(0, p)))


types = st.one_of(st.sampled_from(list(INTS) + [FloatType(), DoubleType(), StringType()]), decimal_types())


def values_of(t):
    if t in INTS:
        b = INTS[t]
        return st.integers(-b, b - 1)
    if isinstance(t, DecimalType):
        # largest value of the type, built exactly (the default decimal context keeps 28 digits)
        text = ("9" * (t.precision - t.scale) or "0") + ("." + "9" * t.scale if t.scale else "")
        return st.decimals(min_value=decimal.Decimal("-" + text), max_value=decimal.Decimal(text),
                           places=t.scale, allow_nan=False, allow_infinity=False)
    if isinstance(t, FloatType):
        return st.floats(width=32, allow_nan=False, allow_infinity=False)
    if isinstance(t, DoubleType):
        return st.floats(allow_nan=False, allow_infinity=False)
    return st.text(max_size=5)


def widened(t, draw):
    """A target type that should hold every value of ``t``."""
    if isinstance(t, DecimalType):
        extra_int = draw(st.integers(0, 38 - t.precision))
        extra_scale = draw(st.integers(0, 38 - t.precision - extra_int))
        return DecimalType(t.precision + extra_int + extra_scale, t.scale + extra_scale)
    if t in INTS:
        digits = len(str(INTS[t] - 1))
        return draw(st.sampled_from([u for u in INTS if INTS[u] >= INTS[t]]
                                    + [DecimalType(digits, 0), DecimalType(digits - 1, 0),
                                       DecimalType(min(38, digits + 2), 2), FloatType(), DoubleType()]))
    if isinstance(t, FloatType):
        return DoubleType()
    return t


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_accepted_pairings_round_trip(spark, data):
    src = data.draw(types)
    dst = widened(src, data.draw) if data.draw(st.booleans()) else data.draw(types)
    accepted = not positional_diff(StructType([StructField("c", src)]), StructType([StructField("c", dst)]))
    if not accepted or isinstance(dst, StringType):
        return  # refused pairings need no guarantee; text targets hold any text form
    vals = data.draw(st.lists(values_of(src), min_size=1, max_size=5))
    df = spark.createDataFrame([(v,) for v in vals], StructType([StructField("c", src)]))
    back = df.select(F.col("c").cast(dst).cast(src).alias("c")).collect()
    assert [r[0] for r in back] == [r[0] for r in df.collect()], (src, dst)


def test_widenings_are_accepted(spark):
    def ok(a, b):
        return not positional_diff(StructType([StructField("c", a)]), StructType([StructField("c", b)]))
    assert ok(IntegerType(), LongType()) and ok(LongType(), DecimalType(38, 12))
    assert ok(DecimalType(17, 2), DecimalType(38, 12)) and ok(FloatType(), DoubleType())
    assert not ok(DecimalType(20, 6), DecimalType(17, 2)) and not ok(LongType(), IntegerType())
    assert not ok(DoubleType(), DecimalType(38, 12)) and not ok(StringType(), IntegerType())
    # integer digits at the boundary
    assert ok(ByteType(), DecimalType(3, 0)) and not ok(ByteType(), DecimalType(2, 0))
    assert ok(IntegerType(), DecimalType(10, 0)) and not ok(IntegerType(), DecimalType(9, 0))
    assert ok(LongType(), DecimalType(19, 0)) and not ok(LongType(), DecimalType(18, 0))
    assert not ok(LongType(), DecimalType(20, 2))
    # integers into floating point: exact only within the mantissa
    assert ok(IntegerType(), DoubleType()) and ok(ShortType(), FloatType())
    assert not ok(LongType(), DoubleType()) and not ok(IntegerType(), FloatType())
