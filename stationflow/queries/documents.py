"""Ordered text documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.functions.text import point_line
from stationflow.operators.documents import (
    curve_documents,
    ordered_parts,
    ordered_text,
    segments_with_points,
    stage_discharge_documents,
    stage_discharge_parts,
    write_documents,
)
from stationflow.queries import query, table


@query("""
    SELECT l_orderkey, string_agg(printf('%f,%f', CAST(l_linenumber AS DOUBLE), l_extendedprice), chr(10)
                                  ORDER BY l_linenumber, l_extendedprice) AS content
    FROM lineitem GROUP BY l_orderkey
""")
def ordered_document(spark, folder):
    return ordered_text(
        table(spark, folder, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_extendedprice"],
        point_line("l_linenumber", "l_extendedprice"),
    )


@query("""
    WITH t AS (SELECT l_orderkey, string_agg(printf('%f,%f,%f', l_quantity, l_extendedprice, l_tax), chr(10)
                      ORDER BY l_quantity, printf('%f,%f,%f', l_quantity, l_extendedprice, l_tax)) AS txt
               FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey AS id, coalesce(txt, '') AS content FROM orders LEFT JOIN t ON l_orderkey = o_orderkey
""")
def curve_document(spark, folder):
    points = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"), "l_quantity", "l_extendedprice", "l_tax")
    curves = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    return curve_documents(curves, points, "l_quantity", ["l_quantity", "l_extendedprice", "l_tax"])


@query("""
    SELECT user_id, string_agg(CAST(event_id AS VARCHAR) || ';' || event_type, chr(10) ORDER BY event_type, event_id) AS content
    FROM events GROUP BY user_id
""")
def large_document(spark, folder):
    line = F.concat(F.col("event_id").cast("string"), F.lit(";"), F.col("event_type"))
    return ordered_text(
        table(spark, folder, "events"), ["user_id"], ["event_type", "event_id"], line
    )


_PARTS_SQL = """
    WITH placed AS (
        SELECT event_type, user_id, event_id, length(CAST(event_id AS VARCHAR)) + 1 AS size,
               sum(length(CAST(event_id AS VARCHAR)) + 1) OVER (PARTITION BY event_type ORDER BY user_id, event_id) AS upto
        FROM events
    )
    SELECT event_type, CAST((upto - size) // 500 + 1 AS BIGINT) AS part,
           string_agg(CAST(event_id AS VARCHAR), chr(10) ORDER BY user_id, event_id) AS content
    FROM placed GROUP BY ALL
"""


@query(_PARTS_SQL)
def document_parts(spark, folder):
    # Short parts.
    return ordered_parts(
        table(spark, folder, "events"), ["event_type"], ["user_id", "event_id"], F.col("event_id").cast("string"), part_bytes=500,
    )


@query("""
    WITH t AS (SELECT l_orderkey AS id, l_linenumber,
                      printf('%f,%f', l_quantity / 1024 + 0.000000123::DOUBLE, l_extendedprice * 1.000000001::DOUBLE) AS line
               FROM lineitem)
    SELECT id, string_agg(line, chr(10) ORDER BY l_linenumber, line) AS content FROM t GROUP BY id
""")
def nine_decimals(spark, folder):
    points = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"), "l_linenumber",
        (F.col("l_quantity") / 1024 + 0.000000123).alias("h"), (F.col("l_extendedprice") * 1.000000001).alias("q"),
    )
    return ordered_text(points, ["id"], ["l_linenumber"], point_line("h", "q"))


@query("""
    WITH seg AS (
        SELECT o_custkey AS id, o_orderkey AS num, o_orderstatus = 'F' AS log, o_orderpriority = '1-URGENT' AS ext,
               o_totalprice AS coffset, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS start_date,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS end_date
        FROM orders),
    pts AS (
        SELECT l_orderkey, count(*) AS n,
               string_agg(printf('%f,%f', l_quantity, l_extendedprice) || chr(10), ''
                          ORDER BY l_quantity, printf('%f,%f', l_quantity, l_extendedprice)) AS txt
        FROM lineitem GROUP BY l_orderkey),
    body AS (
        SELECT seg.id, count(pts.n) AS cnt,
               string_agg(CASE WHEN start_date IS NOT NULL AND end_date IS NOT NULL THEN
                   'StartDate=' || strftime(start_date, '%Y-%m-%d %H:%M') || chr(10)
                   || 'EndDate=' || strftime(end_date, '%Y-%m-%d %H:%M') || chr(10)
                   || 'StartMonth=1' || chr(10) || 'EndMonth=12' || chr(10)
                   || 'Extension=' || CASE WHEN ext THEN 'True' ELSE 'False' END || chr(10)
                   || 'Logarithmic=' || CASE WHEN log THEN 'True' ELSE 'False' END || chr(10)
                   || 'Offset=' || printf('%f', coffset) || chr(10)
                   || 'PointsCount=' || CAST(coalesce(n, 0) AS VARCHAR) || chr(10) || chr(10)
                   || coalesce(txt, '') || chr(10) END, '' ORDER BY num) AS txt
        FROM seg LEFT JOIN pts ON l_orderkey = num GROUP BY seg.id)
    SELECT c_custkey AS id,
           'Delimiter=","' || chr(10) || 'DecimalSeparator="."' || chr(10) || 'DateFormat="yyyy-mm-dd hh:nn"' || chr(10)
           || 'Count=' || CAST(coalesce(cnt, 0) AS VARCHAR) || chr(10) || chr(10) || coalesce(txt, '') AS content
    FROM customer LEFT JOIN body ON body.id = c_custkey
""")
def nested_document(spark, folder):
    return stage_discharge_documents(*_curves(spark, folder))


_SEGMENT_HEAD_SQL = """'StartDate=' || strftime(start_date, '%Y-%m-%d %H:%M') || chr(10)
                   || 'EndDate=' || strftime(end_date, '%Y-%m-%d %H:%M') || chr(10)
                   || 'StartMonth=1' || chr(10) || 'EndMonth=12' || chr(10)
                   || 'Extension=' || CASE WHEN ext THEN 'True' ELSE 'False' END || chr(10)
                   || 'Logarithmic=' || CASE WHEN log THEN 'True' ELSE 'False' END || chr(10)
                   || 'Offset=' || printf('%f', coffset) || chr(10)
                   || 'PointsCount=' || CAST(coalesce(n, 0) AS VARCHAR) || chr(10) || chr(10)"""


@query(f"""
    WITH seg AS (
        SELECT o_custkey AS id, o_orderkey AS num, o_orderstatus = 'F' AS log, o_orderpriority = '1-URGENT' AS ext,
               o_totalprice AS coffset, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS start_date,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS end_date, n
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey),
    dated AS (SELECT * FROM seg WHERE start_date IS NOT NULL AND end_date IS NOT NULL),
    lines AS (
        SELECT c_custkey AS id, 0 AS head, NULL AS num, 0 AS kind, NULL AS h,
               'Delimiter=","' || chr(10) || 'DecimalSeparator="."' || chr(10) || 'DateFormat="yyyy-mm-dd hh:nn"' || chr(10)
               || 'Count=' || CAST(coalesce(cnt, 0) AS VARCHAR) || chr(10) || chr(10) AS line
        FROM customer LEFT JOIN (SELECT id, count(n) AS cnt FROM seg GROUP BY id) AS c ON c.id = c_custkey
        UNION ALL SELECT id, 1, num, 1, NULL, {_SEGMENT_HEAD_SQL} FROM dated
        UNION ALL SELECT id, 1, num, 2, l_quantity, printf('%f,%f', l_quantity, l_extendedprice) || chr(10)
        FROM dated JOIN lineitem ON l_orderkey = num
        UNION ALL SELECT id, 1, num, 3, NULL, chr(10) FROM dated),
    placed AS (
        SELECT *, row_number() OVER every AS place, sum(strlen(line)) OVER every - strlen(line) AS before
        FROM lines WINDOW every AS (PARTITION BY id ORDER BY head, num, kind, h, line ROWS UNBOUNDED PRECEDING))
    SELECT id, CAST(before // 700 + 1 AS BIGINT) AS part, string_agg(line, '' ORDER BY place) AS content
    FROM placed WHERE id IN (SELECT c_custkey FROM customer) GROUP BY ALL
""")
def nested_parts(spark, folder):
    """The same documents in parts of 700 bytes."""
    return stage_discharge_parts(*_curves(spark, folder), part_bytes=700)


def _curves(spark, folder):
    curves = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    orders = table(spark, folder, "orders")
    segments = orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("num"),
        (F.col("o_orderstatus") == "F").alias("log"), (F.col("o_orderpriority") == "1-URGENT").alias("ext"),
        F.col("o_totalprice").alias("coffset"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("start_date"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("end_date"),
    )
    points = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("id"), F.col("l_orderkey").alias("curve_num"),
        F.col("l_quantity").alias("h"), F.col("l_extendedprice").alias("q"),
    )
    return curves, segments, points


@query("""
    WITH d AS (SELECT l_suppkey, string_agg(printf('%f', l_tax), chr(10) ORDER BY l_tax) AS txt FROM lineitem GROUP BY l_suppkey)
    SELECT s_suppkey AS id, CASE WHEN d.l_suppkey IS NULL THEN s_name ELSE txt END AS content
    FROM supplier LEFT JOIN d ON d.l_suppkey = s_suppkey AND s_acctbal > 0
""")
def document_update(spark, folder):
    supplier = table(spark, folder, "supplier")
    targets = supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("content"))
    curves = supplier.where(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("id"))
    points = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("id"), "l_tax")
    return write_documents(targets, curve_documents(curves, points, "l_tax", ["l_tax"]))


@query("""
    SELECT c_custkey AS id, count(DISTINCT CASE WHEN l_orderkey IS NOT NULL THEN o_orderkey END) AS count
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 30
    GROUP BY c_custkey
""")
def segment_counts(spark, folder):
    orders = table(spark, folder, "orders")
    curves = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    segments = orders.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("num"))
    large = table(spark, folder, "lineitem").where(F.col("l_quantity") > 30)
    points = large.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("id"), F.col("l_orderkey").alias("curve_num")
    )
    return segments_with_points(curves, segments, points)
