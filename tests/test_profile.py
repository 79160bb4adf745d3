"""Column profiles: the type lattice, its folding, and the sketch's error."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.errors import CapabilityError
from tablewright.operators.profile import BIT, fits, profile

CASES = {
    "0": {"int", "bigint", "decimal", "double"},
    "-17": {"int", "bigint", "decimal", "double"},
    "2147483648": {"bigint", "decimal", "double"},
    "9223372036854775808": {"decimal", "double"},
    "007": set(), "+5": set(), " 5": set(), "": set(), "-": set(), ".5": set(), "1.": set(),
    "1.50": {"decimal", "double"}, "-0.001": {"decimal", "double"},
    "1e5": {"double"}, "1.5E-7": {"double"},
    "true": {"boolean"}, "FALSE": {"boolean"},
    "2024-02-29": {"date", "timestamp"}, "2023-02-29": set(), "2024-13-01": set(),
    "2024-02-29 23:59:59": {"timestamp"}, "2024-02-29T23:59:59.123456": {"timestamp"},
    "2024-02-29 24:00:01": set(), "abc": set(), "12a": set(),
}


def test_what_a_value_fits(spark):
    rows = spark.createDataFrame([(v,) for v in CASES], "v string").select("v", fits(F.col("v")).alias("bits")).collect()
    assert {r.v: {t for t, b in BIT.items() if r.bits & b} for r in rows} == CASES


@pytest.mark.parametrize("values, kind", [
    (["1", "2", None], "int"), (["1", "3000000000"], "bigint"), (["1", "2.5", "100"], "decimal(4,1)"),
    (["1", "1e9"], "double"), (["2024-01-01", "2024-01-01 10:00:00"], "timestamp"), (["2024-01-01", "1"], "string"),
    (["true", "False"], "boolean"), (["true", "1"], "string"), ([None, None], "void"), ([""], "string"),
    (["1" * 38, "0.1"], "double"), (["1" * 37, "0.1"], "decimal(38,1)"), (["-12.345", "9"], "decimal(5,3)"),
])
def test_a_column_has_the_narrowest_type_of_all_its_values(spark, values, kind):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v string, i int").repartition(3, "i").drop("i")
    assert profile(df).first().type == kind


def test_the_order_and_the_cut_of_rows_do_not_matter(spark):
    df = spark.range(2000).selectExpr(
        "CASE WHEN id % 700 = 3 THEN '1.25' WHEN id % 9 = 0 THEN NULL ELSE CAST(id AS STRING) END AS `a.b`", "'x' AS `select`")
    rows = [profile(d).drop("distinct").collect() for d in (df, df.repartition(7), df.orderBy(F.rand(1)))]
    assert rows[0] == rows[1] == rows[2]
    first, second = rows[0]
    assert (first.name, first.type, first.rows, first.nulls) == ("a.b", "decimal(6,2)", 2000, 223)
    assert (first.min_number, first.max_number, first.longest) == (1.0, 1999.0, 4)
    assert (second.type, second.min_text, second.min_number) == ("string", "x", None)


def test_the_sketch_is_within_five_standard_errors(spark):
    for n in (1, 100, 5_000, 200_000):
        df = spark.range(3 * n).selectExpr(f"CAST(id % {n} AS STRING) AS v")
        assert abs(profile(df).first().distinct - n) <= 5 * 0.016 * n


def test_empty_tables_and_other_types(spark):
    empty = profile(spark.createDataFrame([], "a string, b string")).collect()
    assert [(r.ordinal, r.type, r.rows, r.nulls, r.distinct, r.longest) for r in empty] == [
        (1, "void", 0, 0, 0, None), (2, "void", 0, 0, 0, None)]
    with pytest.raises(CapabilityError, match="n"):
        profile(spark.createDataFrame([(1,)], "n int"))


def test_one_pass_and_a_small_result(spark):
    plan = profile(spark.range(10).selectExpr("CAST(id AS STRING) AS a", "'x' AS b"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") <= 1 and plan.count("Exchange") <= 2


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-10**12, 10**12).map(str), st.decimals(-1000, 1000, places=3).map(str)), min_size=1, max_size=20))
def test_casting_to_the_type_loses_nothing(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    kind = profile(df).first().type
    assert kind in ("int", "bigint") or kind.startswith("decimal")
    assert df.where(F.col("v").try_cast(kind).isNull()).isEmpty()
