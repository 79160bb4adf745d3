import datetime as dt
import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import local_path, write_text
from tablewright.errors import SelfOverwriteError, TableJobError
from tablewright.operators.projection import project_positions
from tablewright.plans import jobs
from tablewright.sinks.csv import write_csv
from tablewright.sources.csv import (
    header_clashes,
    read_csv_header,
    read_csv_positional,
    read_csv_typed,
)


def test_header_filter_is_exact_and_drops_nulls(spark, workdir):
    src = write_text(f"{workdir}/in/a.csv",
                     "Code,Name\nCAE,one\ncae,two\nCAE ,three\n,four\nCAE,\n")
    out = jobs.filter_csv_copy(spark, f"{workdir}/in", f"{workdir}/out", column="Code",
                               view="t_header_filter")
    rows = sorted(out.collect(), key=lambda r: str(r["Name"]))
    assert [(r["Code"], r["Name"]) for r in rows] == [("CAE", None), ("CAE", "one")]
    assert out.columns == ["Code", "Name"]
    assert src


def test_header_filter_keeps_line_breaks_in_values(spark, workdir):
    write_text(f"{workdir}/nl/a.csv", 'Code,Name\nCAE,"two\nlines"\nXYZ,x\n')
    out = jobs.filter_csv_copy(spark, f"{workdir}/nl", f"{workdir}/nl_out", view="t_nl", multiline=True)
    assert [tuple(r) for r in out.collect()] == [("CAE", "two\nlines")]


def test_header_filter_default_value_and_param_override(spark, workdir):
    write_text(f"{workdir}/in/a.csv", "Code,v\nCAE,1\nXYZ,2\n")
    assert jobs.filter_csv_copy(spark, f"{workdir}/in", f"{workdir}/o1", view="t_p1").count() == 1
    got = jobs.filter_csv_copy(spark, f"{workdir}/in", f"{workdir}/o2", view="t_p2",
                               params={"value": "XYZ"}).collect()
    assert [r["v"] for r in got] == ["2"]
    with pytest.raises(ValueError):
        jobs.filter_csv_copy(spark, f"{workdir}/in", f"{workdir}/o3", params={"nope": 1})


def test_ragged_rows_pad_and_cut(spark, workdir):
    write_text(f"{workdir}/r/a.csv", "a,b,c\n1,2\n1,2,3,4\n")
    rows = read_csv_header(spark, f"{workdir}/r").collect()
    assert [tuple(r) for r in rows] == [("1", "2", None), ("1", "2", "3")]
    strict = read_csv_typed(spark, f"{workdir}/r", "a int, b int, c int", header=True, mode="FAILFAST")
    with pytest.raises(Exception):
        strict.collect()


def test_header_names_differing_in_case_are_reported(spark, workdir):
    write_text(f"{workdir}/h/a.csv", "Code,code,A B\n1,2,3\n")
    df = read_csv_header(spark, f"{workdir}/h")
    assert df.columns == ["Code0", "code1", "A B"]
    assert header_clashes(df) == ["Code", "code"]
    write_text(f"{workdir}/h2/a.csv", "a,b,A,c,B\n1,2,3,4,5\n")
    assert header_clashes(read_csv_header(spark, f"{workdir}/h2")) == ["A", "B", "a", "b"]
    write_text(f"{workdir}/h3/a.csv", "x0,y,Code\n1,2,3\n")  # a lone "x0" is not a clash
    assert header_clashes(read_csv_header(spark, f"{workdir}/h3")) == []
    with pytest.raises(TableJobError):
        jobs.filter_csv_copy(spark, f"{workdir}/h", f"{workdir}/o", column="Code")


def test_text_values_roundtrip(spark, workdir):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x,y"), (4, 'q"r'), (5, "n\nl")],
                               "id int, s string")
    write_csv(df, f"{workdir}/t")
    files = glob.glob(local_path(f"{workdir}/t") + "/part-*")
    raw = "".join(open(f).read() for f in files)
    assert '"q""r"' in raw  # RFC-4180 doubling, not backslash
    back = read_csv_typed(spark, f"{workdir}/t", "id int, s string", multiline=True, line_sep="\n")
    got = dict((r["id"], r["s"]) for r in back.collect())
    assert got == {1: None, 2: None, 3: "x,y", 4: 'q"r', 5: "n\nl"}


def test_timestamps_keep_microseconds(spark, workdir):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:07.179575' AS ts")
    write_csv(df, f"{workdir}/ts")
    text = "".join(open(f).read() for f in glob.glob(local_path(f"{workdir}/ts") + "/part-*"))
    assert "07.179575" in text
    back = read_csv_typed(spark, f"{workdir}/ts", "ts timestamp_ntz").collect()
    assert back[0]["ts"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    # Spark's default format would have cut it
    df.write.csv(local_path(f"{workdir}/ts_default"))
    text = "".join(open(f).read() for f in glob.glob(local_path(f"{workdir}/ts_default") + "/part-*"))
    assert "179575" not in text


def test_positional_projection_and_header_line_as_data(spark, workdir):
    write_text(f"{workdir}/p/a.csv", "h0,h1,h2\nx,y,z\n")
    df = jobs.positional_projection(spark, f"{workdir}/p", {2: "type2", 0: "type1"}, view="t_pos")
    assert df.columns == ["type2", "type1"]
    assert sorted(tuple(r) for r in df.collect()) == [("h2", "h0"), ("z", "x")]
    with pytest.raises(IndexError):
        project_positions(read_csv_positional(spark, f"{workdir}/p"), {61: "type2"})


def test_plan_pushes_filter_and_prunes_columns(spark, workdir):
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS a", "'x' AS b", "'y' AS c")
    write_csv(df, f"{workdir}/pp", header=True)
    q = read_csv_header(spark, f"{workdir}/pp").where(F.col("a") == "7").select("a", "c")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(a), EqualTo(a,7)]" in plan
    assert "ReadSchema: struct<a:string,c:string>" in plan


def test_overwrite_of_own_input_is_refused(spark, workdir):
    write_text(f"{workdir}/self/a.csv", "Code\nCAE\n")
    df = read_csv_header(spark, f"{workdir}/self")
    with pytest.raises(SelfOverwriteError):
        write_csv(df, f"{workdir}/self")
    assert os.path.exists(local_path(f"{workdir}/self/a.csv"))
    with pytest.raises(SelfOverwriteError):
        jobs.filter_csv_copy(spark, f"{workdir}/self", f"{workdir}/self/../self")


def test_typed_filter_on_text_ansi_vs_try_cast(spark):
    from tablewright.functions.casts import typed
    df = spark.createDataFrame([("abc",), ("3",), ("9",)], "catid string")
    with pytest.raises(PySparkException):
        df.where(typed("catid", "int") < 7).collect()
    got = df.where(typed("catid", "int", on_bad_value="null") < 7).collect()
    assert [r[0] for r in got] == ["3"]


def test_escape_styles(spark, workdir):
    write_text(f"{workdir}/rfc/a.csv", 'k,v\n1,"say ""hi"""\n')
    write_text(f"{workdir}/bs/a.csv", 'k,v\n1,"say \\"hi\\""\n')
    assert read_csv_header(spark, f"{workdir}/rfc").first()["v"] == 'say "hi"'
    assert read_csv_header(spark, f"{workdir}/bs", escape="\\").first()["v"] == 'say "hi"'


def test_one_column_rows_never_vanish(spark, workdir):
    df = spark.createDataFrame([(" ",), (None,), ("",), ("a",)], "s string")
    write_csv(df, f"{workdir}/one")
    back = read_csv_typed(spark, f"{workdir}/one", "s string", line_sep="\n").collect()
    assert sorted(r["s"] or "" for r in back) == ["", "", " ", "a"]  # "" and null both read as null
    from tablewright.sinks.delimited import write_delimited
    from tablewright.sources.delimited import read_delimited
    import pytest as _pytest
    from pyspark.errors import PySparkException
    with _pytest.raises(PySparkException, match="one-column unquoted"):
        write_delimited(df, f"{workdir}/one_bad")
    no_empty = df.where("s IS NULL OR s <> ''")
    for quoted in (False, True):
        write_delimited(no_empty, f"{workdir}/one_t{quoted}", quoted=quoted)
        got = read_delimited(spark, f"{workdir}/one_t{quoted}", "s string", quoted=quoted).collect()
        assert sorted(r["s"] or "" for r in got) == ["", " ", "a"]


def test_excel_style_csv_with_bom_and_crlf(spark, workdir):
    import os

    os.makedirs(local_path(f"{workdir}/xl"))
    with open(local_path(f"{workdir}/xl/affiliates.csv"), "wb") as f:
        f.write("﻿Code,Name\r\nCAE,one\r\nXYZ,two\r\n".encode("utf-8"))
    out = jobs.filter_csv_copy(spark, f"{workdir}/xl", f"{workdir}/xl_out", view="t_xl")
    assert out.columns == ["Code", "Name"] and [tuple(r) for r in out.collect()] == [("CAE", "one")]


def test_selected_field_after_escaped_quote(spark, workdir):
    write_text(f"{workdir}/q/a.csv", ',,\n,"""",","\n')
    got = read_csv_positional(spark, f"{workdir}/q").select("_c2").collect()
    assert [r[0] for r in got] == [None, ","]
