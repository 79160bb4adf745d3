import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import local_path, write_text
from tablewright.functions.charset import is_standard_charset, outside_charset
from tablewright.plans import jobs
from tablewright.schemas import LIMITS_COLUMNS
from tablewright.sinks.delimited import count_unwritable, write_delimited
from tablewright.sources.delimited import read_delimited
from tablewright.session import unique_name


def _bytes(path):
    return b"".join(open(f, "rb").read() for f in sorted(glob.glob(local_path(path) + "/part-*")))


def test_bad_numbers_read_as_null(spark, workdir):
    write_text(f"{workdir}/b/a.txt", "x\tx\t2,5\n\\N\t\\N\t\\N\nok\t3\t1.5\n")
    rows = read_delimited(spark, f"{workdir}/b", "crit string, up int, low double").collect()
    assert [tuple(r) for r in rows] == [("x", None, None), (None, None, None), ("ok", 3, 1.5)]


def test_windows_1251_bytes_and_roundtrip(spark, workdir):
    df = spark.createDataFrame([("Привет", 1, 0.5)], "crit string, up int, low double")
    write_delimited(df, f"{workdir}/cs", charset="windows-1251")
    assert _bytes(f"{workdir}/cs").startswith(bytes.fromhex("CFF0E8E2E5F2") + b"\t1\t0.5")
    back = read_delimited(spark, f"{workdir}/cs", "crit string, up int, low double",
                          charset="windows-1251").collect()
    assert tuple(back[0]) == ("Привет", 1, 0.5)


def test_unmappable_characters_fail_or_are_counted(spark, workdir):
    df = spark.createDataFrame([("é中",), ("Привет",)], "crit string")
    assert count_unwritable(df, "windows-1251").collect()[0]["unmappable_values"] == 1
    report = count_unwritable(spark.createDataFrame([("a\tb", "\\N"), ("ok", None)], "x string, y string"),
                              "windows-1251").collect()[0]
    assert (report["unmappable_values"], report["embedded_delimiters"], report["null_marker_values"]) == (0, 1, 1)
    with pytest.raises(PySparkException, match="not representable in windows-1251"):
        write_delimited(df, f"{workdir}/um", charset="windows-1251")
    write_delimited(df, f"{workdir}/um2", charset="windows-1251", on_unmappable="replace")
    assert b"??" in _bytes(f"{workdir}/um2")


def test_charset_repertoire(spark):
    df = spark.createDataFrame([("abc",), ("Ёж",), ("€",), ("中",), (None,)], "s string")
    flags = [r[0] for r in df.select(outside_charset(F.col("s"), "windows-1251")).collect()]
    assert flags == [False, False, False, True, False]
    flags = [r[0] for r in df.select(outside_charset(F.col("s"), "iso-8859-1")).collect()]
    assert flags == [False, True, True, True, False]
    assert is_standard_charset("UTF-8") and not is_standard_charset("windows-1251")


def test_embedded_delimiters_rejected_or_quoted(spark, workdir):
    df = spark.createDataFrame([("a\tb", 1), ("n\nl", 2), ("", 3), (None, 4)], "s string, i int")
    with pytest.raises(PySparkException, match="separator or a line break"):
        write_delimited(df, f"{workdir}/e")
    write_delimited(df, f"{workdir}/q", quoted=True)
    back = read_delimited(spark, f"{workdir}/q", "s string, i int", quoted=True).collect()
    assert sorted((r["i"], r["s"]) for r in back) == [(1, "a\tb"), (2, "n\nl"), (3, ""), (4, None)]


def test_unquoted_empty_and_null_stay_apart(spark, workdir):
    df = spark.createDataFrame([("", 1), (None, 2)], "s string, i int")
    write_delimited(df, f"{workdir}/en")
    assert sorted(_bytes(f"{workdir}/en").split(b"\n")) == [b"", b"\t1", b"\\N\t2"]
    back = read_delimited(spark, f"{workdir}/en", "s string, i int").collect()
    assert sorted((r["i"], r["s"]) for r in back) == [(1, ""), (2, None)]


def test_limits_load_replaces_content(spark, workdir):
    rows = spark.createDataFrame([("Привет A", 1, 1.0), ("Привет B", 2, None)], "crit string, up int, low double")
    write_delimited(rows, f"{workdir}/data", charset="windows-1251")
    name = unique_name("limits")
    t = jobs.limits_load(spark, name, f"{workdir}/data", f"{workdir}/tbl", columns=LIMITS_COLUMNS)
    assert sorted(tuple(r) for r in t.collect()) == [("Привет A", 1, 1.0), ("Привет B", 2, None)]
    # the table itself is Windows-1251 text
    from tablewright.sinks.tables import table_meta
    assert bytes.fromhex("CFF0E8E2E5F2") in _bytes(table_meta(spark, name).location)
    again = jobs.limits_load(spark, name, f"{workdir}/data", f"{workdir}/tbl", columns=LIMITS_COLUMNS)
    assert again.count() == 2
    import os
    from conftest import local_path
    assert len([d for d in os.listdir(local_path(workdir)) if d.startswith("tbl")]) == 1


def test_insert_into_text_table_checks_values(spark, workdir):
    from tablewright import catalog
    from tablewright.sinks.tables import insert_overwrite
    name = unique_name("lim_text")
    catalog.create_delimited_table(spark, name, LIMITS_COLUMNS, f"{workdir}/{name}", charset="windows-1251")
    ok = spark.createDataFrame([("Привет", 1, 1.0)], "crit string, up int, low double")
    insert_overwrite(ok, name)
    for bad in ("a\tb", "中"):
        df = spark.createDataFrame([(bad, 2, 2.0)], "crit string, up int, low double")
        with pytest.raises(PySparkException):
            insert_overwrite(df, name)
    assert [tuple(r) for r in spark.table(name).collect()] == [("Привет", 1, 1.0)]


def test_odd_column_names_and_local_timestamps(spark, workdir):
    import datetime as dt
    df = spark.sql("SELECT 'x' AS `a.b`, 'y' AS `c d`, "
                   "CAST(timestamp_ntz'2024-01-01 00:00:07.179575' AS TIMESTAMP) AS ts")
    write_delimited(df, f"{workdir}/odd")
    assert _bytes(f"{workdir}/odd") == b"x\ty\t2024-01-01 00:00:07.179575\n"
    back = read_delimited(spark, f"{workdir}/odd", "`a.b` string, `c d` string, ts timestamp").collect()
    assert back[0][0] == "x" and back[0][1] == "y"
    assert back[0][2].replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)


def test_multibyte_line_breaks_are_refused(spark, workdir):
    from tablewright.errors import CapabilityError
    df = spark.createDataFrame([("a", 1, 1.0)], "crit string, up int, low double")
    for cs in ("utf-16", "utf-32"):
        with pytest.raises(CapabilityError):
            write_delimited(df, f"{workdir}/mb", charset=cs)
        with pytest.raises(CapabilityError):
            read_delimited(spark, f"{workdir}/mb", df.schema, charset=cs)


def test_replace_text_table_checks_values(spark, workdir):
    from tablewright import catalog
    from tablewright.sinks.tables import replace_table
    name = unique_name("lim_text2")
    catalog.create_delimited_table(spark, name, LIMITS_COLUMNS, f"{workdir}/{name}", charset="windows-1251")
    replace_table(spark.createDataFrame([("ok", 1, 1.0)], "crit string, up int, low double"), name)
    with pytest.raises(PySparkException):
        replace_table(spark.createDataFrame([("a\tb", 2, 2.0)], "crit string, up int, low double"), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [("ok", 1, 1.0)]


def test_crlf_files_read_like_hive(spark, workdir):
    data = "Привет\t1\t0.5\r\nмир\t2\t1.5\r\n".encode("cp1251")
    import os

    from conftest import local_path
    os.makedirs(local_path(f"{workdir}/crlf"))
    with open(local_path(f"{workdir}/crlf/limits.data"), "wb") as f:
        f.write(data)
    rows = read_delimited(spark, f"{workdir}/crlf", "crit string, up int, low double",
                          charset="windows-1251").collect()
    assert sorted(tuple(r) for r in rows) == [("Привет", 1, 0.5), ("мир", 2, 1.5)]


def test_crlf_files_string_last_column(spark, workdir):
    import os

    from conftest import local_path
    os.makedirs(local_path(f"{workdir}/crlf2"))
    with open(local_path(f"{workdir}/crlf2/a.data"), "wb") as f:
        f.write("1\tПривет\r\n2\tмир\r\n".encode("cp1251"))
    rows = read_delimited(spark, f"{workdir}/crlf2", "up int, crit string", charset="windows-1251").collect()
    assert sorted(tuple(r) for r in rows) == [(1, "Привет"), (2, "мир")]


def test_load_data_local_uploads_the_driver_file(spark, workdir):
    import tempfile

    from tablewright import catalog
    local_dir = tempfile.mkdtemp(prefix="tw-local-")
    with open(f"{local_dir}/limits.data", "wb") as f:
        f.write("Привет\t1\t0.5\r\n".encode("cp1251"))
    name = unique_name("lim_local")
    catalog.create_delimited_table(spark, name, LIMITS_COLUMNS, f"{workdir}/{name}", charset="windows-1251")
    catalog.load_file_overwrite(spark, name, f"{local_dir}/limits.data", local=True)
    assert [tuple(r) for r in spark.table(name).collect()] == [("Привет", 1, 0.5)]
