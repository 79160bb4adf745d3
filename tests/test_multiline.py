"""Multi-line CSV read split by split, against Python's own csv module."""

import csv
import io

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import local_path
from tablewright.errors import TableJobError
from tablewright.sources.multiline import _Split, read_csv_multiline, records


@pytest.fixture()
def splits_of(spark):
    """Sets the size of a split, in bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {k: spark.conf.get(k, None) for k in keys}

    def use(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")
        spark.conf.set(keys[2], "1")

    yield use
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def as_csv(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def put(workdir, name, text):
    import os
    os.makedirs(local_path(workdir), exist_ok=True)
    with open(f"{local_path(workdir)}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


ROWS = [[str(i), "x" * (i % 5), f'li"ne\n{i},\n\n"end' * (i % 4), "\r\n" * (i % 3) + "t", "ü\n" * (60 if i % 37 == 0 else 0)]
        for i in range(300)]


def collected(df):
    return sorted([["" if v is None else v for v in r] for r in df.collect()], key=lambda r: int(r[0]))


@pytest.mark.parametrize("size", [50, 333, 4096, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_many_splits(spark, workdir, splits_of, size, end):
    splits_of(size)
    put(workdir, "a.csv", as_csv(ROWS, end))
    df = read_csv_multiline(spark, workdir, "a string, b string, c string, d string, e string")
    assert collected(df) == ROWS
    if size <= 333:
        assert spark.read.text(workdir).rdd.getNumPartitions() > 20


def test_headers_and_several_files(spark, workdir, splits_of):
    splits_of(200)
    names = ["id", "b", "two\nlines", "d", "e"]
    for k in range(3):
        put(workdir, f"{k}.csv", "﻿" * (k == 1) + as_csv([names] + ROWS[k::3]))
    df = read_csv_multiline(spark, workdir, header=True)
    assert df.columns == names and collected(df) == ROWS
    put(workdir, "other.csv", as_csv([["id", "b", "c", "d", "e"]] + ROWS[:2]))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv_multiline(spark, workdir, ", ".join(f"`{n}` string" for n in names), header=True).collect()


def test_no_newline_at_the_end_blank_lines_and_ragged_rows(spark, workdir, splits_of):
    splits_of(7)
    put(workdir, "a.csv", '\n1,"a\n\nb",z\n\n2\n3,c,d,e,f\n\n4,"q"')
    df = read_csv_multiline(spark, workdir, "a int, b string, c string")
    assert sorted(map(tuple, df.collect())) == [(1, "a\n\nb", "z"), (2, None, None), (3, "c", "d"), (4, "q", None)]
    assert records(spark, workdir).where("first").count() == 1


def test_empty_and_torn_files(spark, workdir, splits_of):
    splits_of(16)
    put(workdir, "a.csv", "")
    assert read_csv_multiline(spark, workdir, "a string").collect() == []
    put(workdir, "b.csv", 'a,b\n1,"never closed\n2,3\n')
    with pytest.raises(TableJobError, match="do not pair up"):
        read_csv_multiline(spark, workdir, "a string")


fields = st.lists(st.lists(st.text('ab",\n\r', max_size=8), min_size=2, max_size=2), min_size=1, max_size=12)


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(fields, st.lists(st.integers(0, 60), max_size=6))
def test_any_cut_gives_the_same_records(rows, cuts):
    """Lines dealt to splits at any places, put together as the reader does."""
    lines = as_csv(rows).split("\n")[:-1]
    bounds = sorted({0, len(lines), *(c % (len(lines) + 1) for c in cuts)})
    odd, out = False, []
    for a, b in zip(bounds, bounds[1:]):
        split, quotes = _Split("f", a, odd), [line.count('"') for line in lines[a:b]]
        got = [*split.lines(lines[a:b], np.array(quotes)), *split.rest()]
        for text, _, _, piece, _ in got:
            if piece in (0, 1):
                out.append(text)
            else:
                out[-1] += "\n" + text
        odd ^= sum(quotes) % 2 == 1
    assert list(csv.reader(io.StringIO("\n".join(out), newline=""))) == list(csv.reader(io.StringIO(as_csv(rows), newline="")))
    assert [r for r in out if r.count('"') % 2] == []
    assert len(out) == len(rows)
