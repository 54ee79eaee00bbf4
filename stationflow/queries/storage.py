"""Files and folders, written to the shared working folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.functions.text import id_from_file_name
from stationflow.operators.series import canonical
from stationflow.operators.tables import stack
from stationflow.queries import query, table
from stationflow.queries.series import EVENT_LINES_SQL, event_lines
from stationflow.session import work_dir
from stationflow.sinks.files import write_blobs, write_series_dir
from stationflow.sinks.tables import read_series, write_series, write_tables
from stationflow.sources.copytext import read_copy_text, write_copy_text
from stationflow.sources.seriesdir import read_series_dir, read_series_lines
from stationflow.sources.tables import read_blobs, snapshot

_PARSED_SQL = """
    SELECT user_id AS id, strftime(ts, '%Y-%m-%d %H:%M:00') AS ts, CASE WHEN event_type <> 'error' THEN value END AS value,
           CASE WHEN event_type = 'view' THEN '' ELSE event_type END
           || CASE WHEN event_type = 'click' THEN ' ' || props ELSE '' END AS flags
    FROM events
"""


@query(_PARSED_SQL)
def series_file_roundtrip(spark, folder):
    path = work_dir(spark, "series")
    write_series_dir(event_lines(spark, folder), path)
    return read_series_dir(spark, path).withColumn("ts", F.col("ts").cast("string"))


@query(f"SELECT id, line FROM ({EVENT_LINES_SQL})")
def large_series_files(spark, folder):
    # A file for each month of a series.
    path = work_dir(spark, "large-series")
    write_series_dir(event_lines(spark, folder), path, period=F.date_format("ts", "yyyyMM"))
    return read_series_lines(spark, path)


@query("""
    SELECT doc_id, text, CASE WHEN lang = 'de' THEN NULL WHEN lang = 'es' THEN '' ELSE lang END AS lang,
           nullif(n_chars, 5) AS n_chars, text || chr(9) || '\\N' || chr(92) || chr(13) AS odd
    FROM documents
""")
def copy_text_seed(spark, folder):
    lang = F.when(F.col("lang") == "es", "").when(F.col("lang") != "de", F.col("lang"))
    documents = table(spark, folder, "documents").select(
        "doc_id", "text", lang.alias("lang"), F.nullif("n_chars", F.lit(5)).alias("n_chars"),
        F.concat("text", F.lit("\t\\N\\\r")).alias("odd"),
    )
    path = work_dir(spark, "seed")
    write_copy_text(documents, path)
    return read_copy_text(spark, path, "doc_id bigint, text string, lang string, n_chars bigint, odd string")


@query("SELECT page_id, strlen(html) AS bytes, md5(html) AS digest FROM pages")
def blobs_roundtrip(spark, folder):
    path = work_dir(spark, "blobs")
    pages = read_blobs(table(spark, folder, "pages"), "page_id", "html")
    write_blobs(pages, path, F.format_string("%d.page.html", "page_id"), "html")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(path)
    return files.select(
        id_from_file_name("_metadata.file_name").alias("page_id"),
        F.col("length").alias("bytes"), F.md5("content").alias("digest"),
    )


# Every table's columns; those marked are amounts of two decimals or moments.
_TABLES = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal:amount c_mktsegment", "supplier": "s_suppkey s_name s_nationkey s_acctbal:amount",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice:amount",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice:amount o_orderdate:moment o_orderpriority",
    "lineitem": "l_orderkey", "events": "event_id", "embeddings": "vec_id",
    "documents": "doc_id text lang source n_chars", "pages": "page_id url html", "benchmark": "item_id text",
    "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}
_APART = ("LINEITEM", "EVENTS", "EMBEDDINGS")


def _row_sql(columns):
    kinds = {"amount": "CAST(round({} * 100) AS BIGINT)", "moment": "epoch_us({})", "": "{}"}
    parts = (kinds[kind].format(c) for c, _, kind in (c.partition(":") for c in columns.split()))
    return " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '-')" for p in parts)


def _row_text(columns):
    kinds = {
        "amount": lambda c: F.round(F.col(c) * 100).cast("long"),
        "moment": lambda c: F.unix_micros(F.col(c).cast("timestamp")), "": F.col,
    }
    parts = (kinds[kind](c) for c, _, kind in (c.partition(":") for c in columns.split()))
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, CAST(sum(CAST('0x' || left(md5({_row_sql(c)}), 8) AS BIGINT)) AS BIGINT) AS digest, "
        f"CAST(sum(CAST('0x' || md5({_row_sql(c)})[9:16] AS BIGINT)) AS BIGINT) AS second_digest FROM {t}"
        for t, c in _TABLES.items()
        if t.upper() not in _APART
    )
)
def snapshot_counts(spark, folder):
    """Whole rows are read back; their hashes are summed where they are read, in any order."""
    written = snapshot(list(_TABLES), lambda name: table(spark, folder, name), work_dir(spark, "snapshot"), exclude=_APART)
    rows = stack(*[spark.read.parquet(path).select(F.lit(t).alias("table_name"), F.md5(_row_text(_TABLES[t])).alias("md5")) for t, path in written.items()])
    number = lambda at: F.sum(F.conv(F.substring("md5", at, 8), 16, 10).cast("long"))
    return rows.groupBy("table_name").agg(F.count("*").alias("rows"), number(1).alias("digest"), number(9).alias("second_digest"))


@query("""
    SELECT user_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CASE WHEN event_type = 'error' THEN -1.0 ELSE value END AS value,
           CASE WHEN user_id IN (SELECT user_id FROM events WHERE event_type = 'error') THEN 'replaced' ELSE 'first' END AS flags
    FROM events
    WHERE event_type = 'error' OR user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error')
""")
def replace_series(spark, folder):
    events = table(spark, folder, "events")
    path = work_dir(spark, "stored-series")
    write_series(canonical(events, "user_id", "ts", F.col("value"), F.lit("first")), path, bucket_rows=events.count() // 16 + 1)
    errors = events.where(F.col("event_type") == "error")
    # The store keeps its own size of buckets.
    write_series(canonical(errors, "user_id", "ts", F.lit(-1.0), F.lit("replaced")), path, bucket_rows=7)
    return read_series(spark, path).select(
        F.col("id").cast("long").alias("id"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").cast("string").alias("ts"), "value", "flags",
    )


@query("""
    SELECT 'orders' AS table_name, o_orderkey AS id, o_totalprice AS amount FROM orders
    UNION ALL SELECT 'customer', c_custkey, c_acctbal FROM customer
    UNION ALL SELECT 'customer', c_custkey, c_acctbal FROM customer
""")
def append_tables(spark, folder):
    tables = {name: table(spark, folder, name) for name in ("orders", "customer")}
    path = work_dir(spark, "tables")
    written = write_tables(tables, path, prefix="new_")
    write_tables({"customer": tables["customer"]}, path, prefix="new_")
    columns = {"orders": ("o_orderkey", "o_totalprice"), "customer": ("c_custkey", "c_acctbal")}
    return stack(*[
        spark.read.parquet(written[name]).select(F.lit(name).alias("table_name"), F.col(i).alias("id"), F.col(a).alias("amount"))
        for name, (i, a) in columns.items()
    ])
