import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF0001
from tablewright.queries import QUERIES, table

TABLES = ["customer", "orders", "lineitem", "events", "part", "nation"]


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.columns == ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    assert df.count() == 34


def test_every_query_has_an_oracle(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "avro_filter" not in entry.queries()  # spark-avro is not on this classpath


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_at_sf0001(spark, name):
    df = entry.queries()[name](spark, SF0001)
    rows = df.collect()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)

    def canon(cols, rs):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted(tuple(repr(r[i]) for i in order) for r in rs)

    assert canon(df.columns, rows) == canon(ocols, orows)
    assert table(spark, SF0001, "nation").count() == 25
