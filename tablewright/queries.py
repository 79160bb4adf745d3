"""Registered queries: each stages a given table into the format a job
reads, runs the job over the whole table, and returns the job's result.

A query is two steps: ``prepare(spark, sf_dir)`` stages the input (and
returns where it put it), ``run(spark, sf_dir, staged)`` is the job.  The
registered callable does both; ``bench.py`` times them apart.  Staging goes
to a fresh folder under the shared folder, and catalog names are unique per
call, so calls never collide.  ``ORACLE_SQL`` holds the same result as
DuckDB SQL over the original Parquet tables; column names match one for one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import catalog
from tablewright.operators.filters import where_sql
from tablewright.operators import profile as profiles
from tablewright.operators.preview import preview
from tablewright.operators.windows import ranked_running_total
from tablewright.params import JobParam, bind
from tablewright.plans import jobs
from tablewright.schemas import LIMITS_COLUMNS, WIDE_DOCUMENT_COLUMNS
from tablewright.session import has_avro, new_work_dir, unique_name
from tablewright.sinks.avro import write_avro
from tablewright.sinks.csv import write_csv
from tablewright.sinks.delimited import write_delimited
from tablewright.sinks.routed import write_routed
from tablewright.sinks.sequence import write_sequence
from tablewright.sinks.verify import verified_insert_overwrite
from tablewright.sources.avro import read_avro
from tablewright.sources.csv import read_csv_header, read_csv_typed
from tablewright.sources.multiline import read_csv_multiline
from tablewright.sources.quarantine import quarantine_csv
from tablewright.sources.sequence import read_sequence
from tablewright.sources.skipping import build_skip_index, read_csv_skipping
from tablewright.streaming import incremental_filter_csv_copy

@dataclass(frozen=True)
class Staged:
    """A registered query: staging of its input, then the job."""

    run: Callable[[SparkSession, str, Any], DataFrame]
    prepare: Callable[[SparkSession, str], Any] | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = self.prepare(spark, sf_dir) if self.prepare else None
        return self.run(spark, sf_dir, staged)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dealt_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table dealt round-robin over the session's default parallelism,
    for staging only: a table kept as one file would otherwise be staged by
    one task and read by one task.  The jobs themselves deal nothing."""
    return table(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism)


def _staged_rows(name: str) -> Callable[[SparkSession, str], str]:
    """Staging of a given table as Parquet in as many files as there are cores."""
    def stage(spark: SparkSession, sf_dir: str) -> str:
        path = new_work_dir(spark, name)
        dealt_table(spark, sf_dir, name).write.parquet(path)
        return path
    return stage


def _stage_csv(spark: SparkSession, df: DataFrame, label: str, header: bool, **options) -> str:
    path = new_work_dir(spark, label)
    write_csv(df, path, header=header, **options)
    return path


def _stage_table(spark: SparkSession, df: DataFrame, label: str, options: Mapping[str, str] | None = None,
                 provider: str = "parquet") -> str:
    """A catalog table holding ``df``, files in the shared folder."""
    name = unique_name(label)
    df.write.format(provider).options(**(options or {})).option("path", new_work_dir(spark, label)).saveAsTable(name)
    return name


# --- J1: CSV with header → filter → CSV --------------------------------------

def _customer_csv(spark: SparkSession, sf_dir: str) -> str:
    return _stage_csv(spark, dealt_table(spark, sf_dir, "customer"), "customer-csv", header=True)


csv_header_filter = Staged(
    prepare=_customer_csv,
    run=lambda spark, sf_dir, src: jobs.filter_csv_copy(
        spark, src, new_work_dir(spark, "filtered-csv"), column="c_mktsegment",
        params={"value": "BUILDING"}, view=unique_name("table1")),
)

# J1 as an incremental (Structured Streaming, availableNow) run
csv_header_filter_incremental = Staged(
    prepare=_customer_csv,
    run=lambda spark, sf_dir, src: incremental_filter_csv_copy(
        spark, src, new_work_dir(spark, "filtered-stream"), new_work_dir(spark, "stream-checkpoint"),
        column="c_mktsegment", params={"value": "BUILDING"}),
)


def _param_filter(spark: SparkSession, sf_dir: str, _: Any) -> DataFrame:
    """PAR-1: a typed job parameter with a default, bound into the SQL."""
    params = [JobParam("seg", "string", "BUILDING", "Market segment")]
    view = unique_name("customers")
    catalog.register_view(table(spark, sf_dir, "customer"), view)
    return where_sql(spark, view, "c_mktsegment = :seg", bind(params))


param_filter = Staged(run=_param_filter)


# --- CSV fidelity (SNK-1: the write is the job) -----------------------------------

def _csv_overwrite_roundtrip(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    events = spark.read.parquet(src)
    path = new_work_dir(spark, "events-csv")
    write_csv(events, path)
    write_csv(events, path)  # overwrite of an existing target
    return read_csv_typed(spark, path, events.schema, multiline=True, line_sep="\n")


csv_overwrite_roundtrip = Staged(prepare=_staged_rows("events"), run=_csv_overwrite_roundtrip)


# quoted line breaks, in files that are each read by several tasks (SRC-1)
MULTILINE_FROM_EVENTS = [
    "event_id", "ts", "user_id",
    "CASE WHEN event_id % 3 = 0 THEN concat(event_type, chr(10), props, chr(10)) ELSE event_type END AS event_type",
    "value",
    "CASE WHEN event_id % 5 = 0 THEN concat('\"', chr(10), chr(10), ',', props) ELSE props END AS props",
]


def _multiline_csv(spark: SparkSession, sf_dir: str) -> str:
    """A quarter as many files as the session has cores."""
    events = table(spark, sf_dir, "events").repartition(max(1, spark.sparkContext.defaultParallelism // 4))
    return _stage_csv(spark, events.selectExpr(*MULTILINE_FROM_EVENTS), "multiline-csv", header=True)


csv_multiline_split = Staged(
    prepare=_multiline_csv,
    run=lambda spark, sf_dir, src: read_csv_multiline(
        spark, src, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
        header=True),
)


# --- malformed records apart (SRC-1, SRC-2) ---------------------------------------

QUARANTINE_SCHEMA = "orderkey bigint, line int, flag string, quantity int"
_GOOD_LINE = ("concat_ws(',', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
              "concat('\"a, \"\"', l_returnflag, '\"\"\"'), CAST(CAST(l_quantity AS INT) AS STRING))")
LINES_FROM_LINEITEM = ("CASE l_orderkey % 50 WHEN 0 THEN concat(CAST(l_orderkey AS STRING), ',', l_returnflag) "
                       f"WHEN 1 THEN concat({_GOOD_LINE}, ',') WHEN 2 THEN concat('x', {_GOOD_LINE}) ELSE {_GOOD_LINE} END")


def _faulty_lines(spark: SparkSession, sf_dir: str) -> str:
    path = new_work_dir(spark, "faulty-csv")
    dealt_table(spark, sf_dir, "lineitem").selectExpr(f"{LINES_FROM_LINEITEM} AS value").write.text(path)
    return path


def _csv_quarantine(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    """Good rows and rejects in one frame, the rejects with their reason."""
    found = quarantine_csv(spark, src, QUARANTINE_SCHEMA)
    return found.good.unionByName(found.rejects.drop("file"), allowMissingColumns=True)


csv_quarantine = Staged(prepare=_faulty_lines, run=_csv_quarantine)


# --- FLT-1, FLT-2 over text files with a skip index --------------------------------

SKIPPED = [("l_partkey", "<", 150), ("l_linenumber", "=", 3), ("l_returnflag", "=", "R")]


def _indexed_csv(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """lineitem as CSV, in files of neighbouring part keys, and its index."""
    rows = table(spark, sf_dir, "lineitem")
    rows = rows.repartitionByRange(4 * spark.sparkContext.defaultParallelism, "l_partkey")
    path, schema = new_work_dir(spark, "indexed-csv"), ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    write_csv(rows, path, header=True)
    build_skip_index(spark, path, schema, [c for c, _, _ in SKIPPED], header=True)
    return path, schema


csv_skipping_filter = Staged(
    prepare=_indexed_csv,
    run=lambda spark, sf_dir, staged: read_csv_skipping(spark, staged[0], staged[1], SKIPPED, header=True),
)


# --- PRV-3 over text: the narrowest type of every column ---------------------------

text_profile = Staged(
    prepare=lambda spark, sf_dir: _stage_csv(spark, dealt_table(spark, sf_dir, "lineitem"), "lineitem-text", header=True),
    # the estimate of distinct values has no counterpart in SQL; a test measures its error
    run=lambda spark, sf_dir, src: profiles.profile(read_csv_header(spark, src)).drop("distinct"),
)


# --- J4: headerless CSV → columns by position ---------------------------------

WIDE_CSV_WIDTH = 62


def wide_csv_columns(lineitem_columns: list[str]) -> list[str]:
    """62 text columns from lineitem: column i is ``'i|' || column (i mod 11)``."""
    k = len(lineitem_columns)
    return [f"concat('{i}|', CAST({lineitem_columns[i % k]} AS STRING)) AS w{i}"
            for i in range(WIDE_CSV_WIDTH)]


# A compressed file is read by one task: a file ends after so many rows, so that tasks stay small however large the table.
WIDE_CSV_FILES = {"maxRecordsPerFile": "250000", "zlib.compress.level": "BEST_SPEED"}


def _wide_csv(spark: SparkSession, sf_dir: str) -> str:
    li = dealt_table(spark, sf_dir, "lineitem")
    return _stage_csv(spark, li.selectExpr(*wide_csv_columns(li.columns)), "wide-csv", header=False,
                      compression="gzip", options=WIDE_CSV_FILES)


csv_positional_project = Staged(
    prepare=lambda spark, sf_dir: _stage_csv(spark, dealt_table(spark, sf_dir, "lineitem"),
                                             "lineitem-csv", header=False),
    run=lambda spark, sf_dir, src: jobs.positional_projection(
        spark, src, {8: "type1", 0: "region", 9: "type2"}, view=unique_name("table1")),
)

csv_wide_positional_project = Staged(
    prepare=_wide_csv,
    run=lambda spark, sf_dir, src: jobs.positional_projection(
        spark, src, {20: "type1", 31: "region", 61: "type2"}, view=unique_name("table1")),
)


# --- J2 / CAT-10: filter one table into another ---------------------------------

def _category(spark: SparkSession, sf_dir: str) -> str:
    return _stage_table(spark, dealt_table(spark, sf_dir, "customer"), "category")


def _filter_copy(spark: SparkSession, src: str) -> tuple[DataFrame, DataFrame]:
    dst = unique_name("category_after")
    return jobs.filter_copy(
        spark, jobs.CatalogTable(src), jobs.CatalogTable(dst, new_work_dir(spark, dst)),
        predicate="c_nationkey < :limit", view=unique_name("table11"))


def _view_rebinding(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    """The unfiltered handle kept across the view's re-binding still sees
    every row; the filtered frame sees the filtered ones."""
    unfiltered, written = _filter_copy(spark, src)
    return (unfiltered.withColumn("handle", F.lit("unfiltered"))
            .unionByName(written.withColumn("handle", F.lit("filtered"))))


catalog_filter_copy = Staged(prepare=_category,
                             run=lambda spark, sf_dir, src: _filter_copy(spark, src)[1])
view_rebinding = Staged(prepare=_category, run=_view_rebinding)


def _one_scan_two_targets(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    """CAT-10 and SNK-4 at once: the whole table and a filtered copy, written in one pass."""
    whole, part = new_work_dir(spark, "category-all"), new_work_dir(spark, "category-after")
    write_routed(spark.table(src), {whole: None, part: F.col("c_nationkey") < 7})
    return (spark.read.parquet(whole).withColumn("handle", F.lit("unfiltered"))
            .unionByName(spark.read.parquet(part).withColumn("handle", F.lit("filtered"))))


one_scan_two_targets = Staged(prepare=_category, run=_one_scan_two_targets)


# --- J3: external table over a data source -------------------------------------

connector_catalog_table = Staged(
    prepare=_customer_csv,
    run=lambda spark, sf_dir, src: jobs.external_table_scan(
        spark, unique_name("external_customer"), "csv", {"path": src, "header": "true", "escape": '"'}),
)


# an external CSV table whose quoted values hold doubled quotes and separators, a subset of its columns
QUOTED_FROM_CUSTOMER = [
    "concat(c_name, '\"', c_mktsegment, '\"') AS label",
    "CASE WHEN c_nationkey % 2 = 0 THEN ',' ELSE concat('\"', c_name, '\",') END AS mark",
    "CAST(c_custkey AS STRING) AS code",
    "c_mktsegment AS segment",
]


def _external_quoted_table(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    name = unique_name("external_quoted")
    jobs.external_table_scan(spark, name, "csv", {"path": src, "header": "true", "escape": '"'})
    return spark.table(name).select("mark", "segment")


external_quoted_table = Staged(
    prepare=lambda spark, sf_dir: _stage_csv(
        spark, dealt_table(spark, sf_dir, "customer").selectExpr(*QUOTED_FROM_CUSTOMER), "quoted-csv", header=True),
    run=_external_quoted_table,
)


# --- J6: delimited Windows-1251 text table --------------------------------------

LIMITS_FROM_CUSTOMER = [
    "CASE WHEN c_nationkey = 3 THEN '' WHEN c_nationkey <> 4 THEN concat('Привет ', c_name) END AS crit",
    "c_nationkey AS up",
    "c_acctbal AS low",
]


def _limits_file(spark: SparkSession, sf_dir: str) -> str:
    rows = dealt_table(spark, sf_dir, "customer").selectExpr(*LIMITS_FROM_CUSTOMER)
    data_file = new_work_dir(spark, "limits-data")
    write_delimited(rows, data_file, sep="\t", charset="windows-1251")
    return data_file


def _limits_load(spark: SparkSession, sf_dir: str, data_file: str) -> DataFrame:
    name = unique_name("limits")
    return jobs.limits_load(spark, name, data_file, new_work_dir(spark, name),
                            charset="windows-1251", columns=LIMITS_COLUMNS)


delimited_charset_load = Staged(prepare=_limits_file, run=_limits_load)


# --- J7: positional snapshot copies ---------------------------------------------

SNAPSHOT_COLUMNS = [
    ("o_orderkey", "decimal(38,12)"),
    ("o_custkey", "decimal(38,12)"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "decimal(17,2)"),
    ("o_orderdate", "timestamp"),
    ("o_orderpriority", "string"),
]


def _snapshot_source_exprs() -> list[str]:
    return [f"CAST({n} AS {'TIMESTAMP_NTZ' if t == 'timestamp' else t.upper()}) AS {n}"
            for n, t in SNAPSHOT_COLUMNS]


def _snapshot_copy(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    dst = unique_name("archive")
    loc = new_work_dir(spark, dst)
    jobs.snapshot_copy(spark, src, dst, columns=SNAPSHOT_COLUMNS, location=loc)
    # a second run replaces the content (the row count stays the same)
    return jobs.snapshot_copy(spark, src, dst, columns=SNAPSHOT_COLUMNS, location=loc)


snapshot_copy = Staged(
    prepare=lambda spark, sf_dir: _stage_table(
        spark, dealt_table(spark, sf_dir, "orders").selectExpr(*_snapshot_source_exprs()),
        "documents_source"),
    run=_snapshot_copy,
)


def _verified_table_copy(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    """SNK-4 with the written table compared to what was written."""
    dst = unique_name("verified_archive")
    catalog.create_table(spark, dst, SNAPSHOT_COLUMNS, location=new_work_dir(spark, dst))
    verified_insert_overwrite(spark.table(src), dst, source_tables=[src])
    return spark.table(dst)


verified_table_copy = Staged(prepare=snapshot_copy.prepare, run=_verified_table_copy)


def wide_document_exprs(dialect: str) -> list[str]:
    """The 163 document-archive columns derived from one orders row.

    Strings carry tabs, newlines, empty values and nulls; decimals, money
    and rates come exactly from integers or two-decimal prices; timestamps
    carry microseconds.  ``dialect`` is ``spark`` or ``duckdb`` (they differ
    only in timestamp arithmetic).
    """
    out = []
    for k, (name, typ) in enumerate(WIDE_DOCUMENT_COLUMNS, start=1):
        if typ == "string":
            if k % 7 == 0:
                e = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat(o_orderpriority, chr(9), o_orderstatus) END"
            elif k % 7 == 3:
                e = f"CASE WHEN o_orderstatus = 'F' THEN '' ELSE concat('{name}', chr(10), CAST(o_custkey AS STRING)) END"
            else:
                e = f"concat('{name}:', CAST(o_orderkey AS STRING))"
        elif typ == "decimal(38,12)":
            e = ["CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS DECIMAL(38,12))",
                 "CAST(o_orderkey AS DECIMAL(38,12))",
                 "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(-o_custkey AS DECIMAL(38,12)) END"][k % 3]
        elif typ in ("decimal(17,2)", "decimal(20,6)"):
            e = f"CAST(o_totalprice AS {typ.upper()})"
        elif typ == "decimal(8,0)":
            e = "CAST(o_orderkey % 100000000 AS DECIMAL(8,0))"
        elif typ == "bigint":
            e = f"o_orderkey * {k}"
        elif typ == "timestamp":
            micros = f"(o_orderkey % 1000000) + {k}"
            e = (f"timestampadd(MICROSECOND, {micros}, o_orderdate)" if dialect == "spark"
                 else f"o_orderdate + to_microseconds({micros})")
        else:
            raise ValueError(typ)
        out.append(f"{e} AS {name}")
    return out


# Storage of the wide tables.  Most of their columns hold nearly as many values as rows: a dictionary is built for
# each, outgrown and dropped; values next to each other are coded by their difference instead, and compressed by zstd.
# A page ends by its bytes: cut at 20,000 rows, as by default, most of these columns' pages hold too little to compress.
WIDE_STORAGE = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary": "false",
                "parquet.page.row.count.limit": "1000000", "parquet.compression.codec.zstd.level": "6"}


# Storage of the wide source.  ORC keeps a decimal in as many bytes as its digits need, without trailing zeros, where
# Parquet keeps a decimal(38,12) in 16.  With 163 columns its buffers would come out so small that zstd finds little.
WIDE_SOURCE = {"compression": "zstd", "orc.compression.zstd.level": "6", "orc.dictionary.key.threshold": "0",
               "orc.buffer.size.enforce": "true", "orc.compress.size": "65536"}


def _wide_source(spark: SparkSession, sf_dir: str) -> str:
    """In key order over all files, so that neighbours are alike.  Ranges are cut by key and place in the table:
    rows of one key, or without a key, may lie in several files, however many they are."""
    rows = (table(spark, sf_dir, "orders").withColumn("__row", F.monotonically_increasing_id())
            .repartitionByRange(spark.sparkContext.defaultParallelism, "o_orderkey", "__row")
            .sortWithinPartitions("o_orderkey"))
    return _stage_table(spark, rows.selectExpr(*wide_document_exprs("spark")), "wide_documents", WIDE_SOURCE, "orc")


def _wide_table_copy(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    """CAT-5: creates the 163-column table, then overwrites it by position."""
    dst = unique_name("wide_archive")
    loc = new_work_dir(spark, dst)
    jobs.snapshot_copy(spark, src, dst, columns=WIDE_DOCUMENT_COLUMNS, location=loc, options=WIDE_STORAGE)
    return jobs.snapshot_copy(spark, src, dst, columns=WIDE_DOCUMENT_COLUMNS, location=loc, options=WIDE_STORAGE)


wide_table_copy = Staged(prepare=_wide_source, run=_wide_table_copy)

wide_snapshot_copy = Staged(
    prepare=_wide_source,
    run=lambda spark, sf_dir, src: jobs.snapshot_copy(
        spark, src, jobs.SequenceTable(new_work_dir(spark, "wide_archive_seq"),
                                       WIDE_DOCUMENT_COLUMNS)),
)


def _sequencefile_copy(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    events = spark.read.parquet(src)
    path = new_work_dir(spark, "events-seq")
    write_sequence(events, path, compression="BLOCK")
    return read_sequence(spark, path, events.schema)


sequencefile_copy = Staged(prepare=_staged_rows("events"), run=_sequencefile_copy)


def _sequencefile_hive_copy(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    """SNK-5 in the Hive layout: unquoted tab-separated records, ``\\N`` for null."""
    events = spark.read.parquet(src)
    path = new_work_dir(spark, "events-seq-hive")
    write_sequence(events, path, compression="BLOCK", record_format="hive")
    return read_sequence(spark, path, events.schema, record_format="hive")


sequencefile_hive_copy = Staged(prepare=_staged_rows("events"), run=_sequencefile_hive_copy)


# --- J5: Avro (registered only where the avro data source exists) ------------------

def _part_avro(spark: SparkSession, sf_dir: str) -> str:
    path = new_work_dir(spark, "episodes-avro")
    write_avro(dealt_table(spark, sf_dir, "part"), path)
    return path


avro_filter = Staged(prepare=_part_avro,
                     run=lambda spark, sf_dir, src: read_avro(spark, src).where("p_size > 5"))
avro_overwrite_roundtrip = Staged(
    prepare=_part_avro,
    run=lambda spark, sf_dir, src: jobs.avro_subset_copy(
        spark, src, new_work_dir(spark, "episodes-avro-result"), predicate="p_size > 5"),
)


def avro_queries(spark: SparkSession | None) -> dict[str, Staged]:
    """The Avro jobs, when ``spark`` can read and write Avro."""
    if spark is None or not has_avro(spark):
        return {}
    return {"avro_filter": avro_filter, "avro_overwrite_roundtrip": avro_overwrite_roundtrip}


# --- filters, previews, windows ----------------------------------------------------

# FLT-3 (``df.where("doctor > 5")``) on a typed source
typed_expr_filter = Staged(run=lambda spark, sf_dir, _: table(spark, sf_dir, "part").where("p_size > 5"))

preview_rows = Staged(run=lambda spark, sf_dir, _: preview(table(spark, sf_dir, "customer"), 20,
                                                            order_by=["c_custkey"]))


def _window_rank_running_total(spark: SparkSession, sf_dir: str, _: Any) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
        F.col("o_totalprice").cast("decimal(17,2)").alias("price"))
    out = ranked_running_total(orders, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")],
                               "price", rank_col="rn", total_col="running_total")
    return out.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "rn", "running_total")


window_rank_running_total = Staged(run=_window_rank_running_total)


QUERIES: dict[str, Staged] = {
    "csv_header_filter": csv_header_filter,
    "csv_header_filter_incremental": csv_header_filter_incremental,
    "param_filter": param_filter,
    "csv_overwrite_roundtrip": csv_overwrite_roundtrip,
    "csv_positional_project": csv_positional_project,
    "csv_wide_positional_project": csv_wide_positional_project,
    "catalog_filter_copy": catalog_filter_copy,
    "view_rebinding": view_rebinding,
    "connector_catalog_table": connector_catalog_table,
    "external_quoted_table": external_quoted_table,
    "delimited_charset_load": delimited_charset_load,
    "snapshot_copy": snapshot_copy,
    "wide_snapshot_copy": wide_snapshot_copy,
    "wide_table_copy": wide_table_copy,
    "sequencefile_copy": sequencefile_copy,
    "sequencefile_hive_copy": sequencefile_hive_copy,
    "typed_expr_filter": typed_expr_filter,
    "preview_rows": preview_rows,
    "window_rank_running_total": window_rank_running_total,
    "one_scan_two_targets": one_scan_two_targets,
    "csv_multiline_split": csv_multiline_split,
    "csv_quarantine": csv_quarantine,
    "csv_skipping_filter": csv_skipping_filter,
    "text_profile": text_profile,
    "verified_table_copy": verified_table_copy,
}


def _customer_as_text() -> str:
    return ("CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, "
            "CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
            "CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment")


def _wide_csv_oracle() -> str:
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    exprs = {i: e for i, e in enumerate(wide_csv_columns(cols))}
    pick = {20: "type1", 31: "region", 61: "type2"}
    return "SELECT " + ", ".join(exprs[i].rsplit(" AS ", 1)[0] + f" AS {a}" for i, a in pick.items()) \
        + " FROM lineitem"


def _quarantine_oracle() -> str:
    short, more, bad = ("l_orderkey % 50 = 0", "l_orderkey % 50 = 1", "l_orderkey % 50 = 2")
    reject = f"({short} OR {more} OR {bad})"
    columns = {"orderkey": "l_orderkey", "line": "l_linenumber", "flag": "concat('a, \"', l_returnflag, '\"')",
               "quantity": "CAST(l_quantity AS INT)"}
    return "SELECT " + ", ".join(f"CASE WHEN NOT {reject} THEN {e} END AS {n}" for n, e in columns.items()) + (
        f", CASE WHEN {short} THEN '2 of 4 fields' WHEN {more} THEN '5 fields, not 4' "
        f"WHEN {bad} THEN 'orderkey: not bigint' END AS reason, "
        f"CASE WHEN {reject} THEN {LINES_FROM_LINEITEM} END AS record FROM lineitem")


def _profile_oracle() -> str:
    """The profile of one text column after the other."""
    text = {n: f"CAST({n} AS VARCHAR)" for n in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")} | {"l_shipdate": "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f')"}
    whole = "length(split_part(ltrim(t, '-'), '.', 1))"
    scale = "length(split_part(t, '.', 2))"
    out = []
    for i, (name, expr) in enumerate(text.items(), start=1):
        def every(pattern: str, kind: str) -> str:
            return f"bool_and(regexp_matches(t, '{pattern}') AND TRY_CAST(t AS {kind}) IS NOT NULL)"
        number = f"bool_and(regexp_matches(t, '{profiles.NUMBER}'))"
        out.append(
            f"SELECT {i} AS ordinal, '{name}' AS name, CASE WHEN count(t) = 0 THEN 'void' "
            "WHEN bool_and(lower(t) IN ('true', 'false')) THEN 'boolean' "
            f"WHEN {every(profiles.INTEGER, 'INTEGER')} THEN 'int' WHEN {every(profiles.INTEGER, 'BIGINT')} THEN 'bigint' "
            f"WHEN bool_and(regexp_matches(t, '{profiles.DECIMAL}')) AND max({whole}) + max({scale}) <= 38 "
            f"THEN concat('decimal(', max({whole}) + max({scale}), ',', max({scale}), ')') "
            f"WHEN {every(profiles.NUMBER, 'DOUBLE')} THEN 'double' WHEN {every(profiles.DATE, 'DATE')} THEN 'date' "
            f"WHEN {every(profiles.TIMESTAMP, 'TIMESTAMP')} THEN 'timestamp' ELSE 'string' END AS type, "
            "count(*) AS rows, count(*) - count(t) AS nulls, min(t) AS min_text, max(t) AS max_text, "
            f"CASE WHEN {number} THEN min(TRY_CAST(t AS DOUBLE)) END AS min_number, "
            f"CASE WHEN {number} THEN max(TRY_CAST(t AS DOUBLE)) END AS max_number, max(length(t)) AS longest "
            f"FROM (SELECT {expr} AS t FROM lineitem)")
    return " UNION ALL ".join(out)


ORACLE_SQL: dict[str, str] = {
    "one_scan_two_targets": ("SELECT *, 'unfiltered' AS handle FROM customer UNION ALL "
                             "SELECT *, 'filtered' AS handle FROM customer WHERE c_nationkey < 7"),
    "csv_multiline_split": "SELECT " + ", ".join(MULTILINE_FROM_EVENTS) + " FROM events",
    "csv_quarantine": _quarantine_oracle(),
    "csv_skipping_filter": "SELECT * FROM lineitem WHERE l_partkey < 150 AND l_linenumber = 3 AND l_returnflag = 'R'",
    "text_profile": _profile_oracle(),
    "verified_table_copy": "SELECT " + ", ".join(
        f"CAST({n} AS {'TIMESTAMP' if t == 'timestamp' else t.upper()}) AS {n}" for n, t in SNAPSHOT_COLUMNS) + " FROM orders",
    "csv_header_filter": f"SELECT {_customer_as_text()} FROM customer WHERE c_mktsegment = 'BUILDING'",
    "csv_header_filter_incremental": (f"SELECT {_customer_as_text()} FROM customer "
                                      "WHERE c_mktsegment = 'BUILDING'"),
    "param_filter": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "csv_overwrite_roundtrip": "SELECT * FROM events",
    "csv_positional_project": ("SELECT l_returnflag AS type1, CAST(l_orderkey AS VARCHAR) AS region, "
                               "l_linestatus AS type2 FROM lineitem"),
    "csv_wide_positional_project": _wide_csv_oracle(),
    "catalog_filter_copy": "SELECT * FROM customer WHERE c_nationkey < 7",
    "view_rebinding": ("SELECT *, 'unfiltered' AS handle FROM customer UNION ALL "
                       "SELECT *, 'filtered' AS handle FROM customer WHERE c_nationkey < 7"),
    "connector_catalog_table": f"SELECT {_customer_as_text()} FROM customer",
    "external_quoted_table": "SELECT " + ", ".join(QUOTED_FROM_CUSTOMER[i] for i in (1, 3)) + " FROM customer",
    "delimited_charset_load": "SELECT " + ", ".join(LIMITS_FROM_CUSTOMER) + " FROM customer",
    "snapshot_copy": "SELECT " + ", ".join(
        f"CAST({n} AS {'TIMESTAMP' if t == 'timestamp' else t.upper()}) AS {n}"
        for n, t in SNAPSHOT_COLUMNS) + " FROM orders",
    "wide_snapshot_copy": "SELECT " + ", ".join(wide_document_exprs("duckdb")) + " FROM orders",
    "wide_table_copy": "SELECT " + ", ".join(wide_document_exprs("duckdb")) + " FROM orders",
    "sequencefile_copy": "SELECT * FROM events",
    "sequencefile_hive_copy": "SELECT * FROM events",
    "avro_filter": "SELECT * FROM part WHERE p_size > 5",
    "avro_overwrite_roundtrip": "SELECT * FROM part WHERE p_size > 5",
    "typed_expr_filter": "SELECT * FROM part WHERE p_size > 5",
    "preview_rows": "SELECT * FROM customer ORDER BY c_custkey LIMIT 20",
    "window_rank_running_total": (
        "SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, "
        "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(17,2))) OVER (PARTITION BY o_custkey "
        "ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
        "AS DECIMAL(38,2)) AS running_total FROM orders"),
}
