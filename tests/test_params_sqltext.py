import datetime as dt
import decimal

import pytest

from tablewright.params import JobParam, bind
from tablewright.sinks.sequence import codec_class
from tablewright.sqltext import ident, string


def test_parameter_types_and_defaults():
    params = [JobParam("seg", "string", "BUILDING"), JobParam("limit", "int", 7),
              JobParam("rate", "decimal", decimal.Decimal("0.5")), JobParam("day", "date"),
              JobParam("flag", "boolean", False)]
    assert bind(params) == {"seg": "BUILDING", "limit": 7, "rate": decimal.Decimal("0.5"),
                            "day": None, "flag": False}
    got = bind(params, {"limit": "12", "rate": "1.25", "day": "2024-02-29", "flag": "yes"})
    assert got["limit"] == 12 and got["rate"] == decimal.Decimal("1.25")
    assert got["day"] == dt.date(2024, 2, 29) and got["flag"] is True
    for bad in ({"limit": "x"}, {"flag": "maybe"}, {"rate": "abc"}, {"nope": 1}):
        with pytest.raises((ValueError, decimal.InvalidOperation)):
            bind(params, bad)


def test_bound_parameters_are_literals(spark):
    spark.createDataFrame([("a'b",), ("c",)], "v string").createOrReplaceTempView("tw_lit")
    assert spark.sql("SELECT * FROM tw_lit WHERE v = :v", args={"v": "a'b"}).count() == 1


def test_sql_quoting(spark):
    assert ident("a`b") == "`a``b`"
    tricky = "it's a \\ path"
    assert spark.sql(f"SELECT {string(tricky)} AS s").first()["s"] == tricky


def test_codec_class():
    assert codec_class("NONE") is None
    assert codec_class("block", "gzip") == "org.apache.hadoop.io.compress.GzipCodec"
    with pytest.raises(ValueError):
        codec_class("ZIP")
