"""Time-series records."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.functions.decode import compass_degrees
from stationflow.functions.records import is_month_start
from stationflow.operators.quality import month_start_violations
from stationflow.operators.series import (
    cloud_lines,
    merged_kinds,
    number_lines,
    phases,
    series_ids,
    series_texts,
    shifted_series,
    text_lines,
    weather_lines,
    with_phases,
)
from stationflow.operators.tables import stack
from stationflow.queries import query, table

# Event lines the way the record files have them.
EVENT_LINES_SQL = """
    SELECT user_id AS id, ts,
           strftime(ts, '%Y-%m-%d %H:%M') || ','
           || CASE WHEN event_type = 'error' THEN '' ELSE regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') END || ','
           || CASE WHEN event_type = 'view' THEN '' ELSE event_type END
           || CASE WHEN event_type = 'click' THEN ' ' || props ELSE '' END AS line
    FROM events
"""


def event_lines(spark, folder):
    kind = F.col("event_type")
    records = table(spark, folder, "events").select(
        F.col("user_id").alias("id"), F.col("ts").alias("datein"),
        F.when(kind != "view", kind).alias("flag"),
        F.when(kind != "error", F.col("value")).alias("value"),
        F.when(kind == "click", F.col("props")).when(kind == "signup", "0").when(kind == "error", "").alias("additional"),
    )
    return number_lines(records)


@query(f"SELECT id, line FROM ({EVENT_LINES_SQL})")
def series_records(spark, folder):
    return event_lines(spark, folder).select("id", "line")


@query(f"""
    SELECT id, 1 AS part, string_agg(line || chr(13) || chr(10), '' ORDER BY ts, line) AS content FROM ({EVENT_LINES_SQL}) GROUP BY id
""")
def series_text(spark, folder):
    return series_texts(event_lines(spark, folder))


_COMPASS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW", "EN", "ES", "WS", "WN", "XX", "", "0"]
_DEGREES = ["0", "45", "90", "135", "180", "225", "270", "315", "45", "135", "225", "315", "", "", "0"]


@query(f"""
    WITH w AS (
        SELECT event_id, user_id, ts, event_type, ({_COMPASS})[user_id % 15 + 1] AS value, ({_DEGREES})[user_id % 15 + 1] AS degrees
        FROM events)
    SELECT event_id, CASE WHEN event_type <> 'view' THEN degrees END AS degrees,
           strftime(ts, '%Y-%m-%d %H:%M') || ',' || CASE WHEN event_type <> 'view' THEN degrees ELSE '' END || ',' || event_type AS line
    FROM w
""")
def compass_decode(spark, folder):
    name = F.get(F.array(*[F.lit(n) for n in _COMPASS]), (F.col("user_id") % 15).cast("int"))
    value = F.when(F.col("event_type") != "view", name)
    records = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("datein"), F.col("event_type").alias("flag"),
        value.alias("value"), F.lit(None).cast("string").alias("additional"),
    )
    lines = text_lines(records.withColumn("id", F.struct("id", compass_degrees("value").alias("degrees"))))
    return lines.select(F.col("id.id").alias("event_id"), F.col("id.degrees").alias("degrees"), "line")


@query("""
    WITH c AS (
        SELECT *, strftime(l_shipdate, '%Y-%m-%d %H:%M') AS d, CAST(l_linenumber AS VARCHAR) AS t,
               CASE WHEN l_returnflag <> 'N' THEN CAST(l_discount AS VARCHAR) ELSE '' END AS p,
               CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS VARCHAR) ELSE '' END AS h
        FROM lineitem)
    SELECT l_orderkey AS id, 'cloud' AS kind,
           d || ',,' || t || '/' || p || '/' || h || ' ' || p || '/' || h || '/' || t || ' '
           || h || '/' || t || '/' || p || ' ' || t || '/' || t || '/' || t AS line FROM c
    UNION ALL SELECT l_orderkey, 'weather', d || ',,' || t || '/' || p || '/' || h FROM c
""")
def pack_columns(spark, folder):
    t = F.col("l_linenumber").cast("string")
    p = F.when(F.col("l_returnflag") != "N", F.col("l_discount").cast("string"))
    h = F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("string"))
    layers = [(t, p, h), (p, h, t), (h, t, p), (t, t, t)]
    named = {
        f"{name}{i}": c
        for i, layer in enumerate(layers, 1)
        for name, c in zip(("cloud_type", "cloud_pct", "cloud_height"), layer)
    }
    base = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("datein"),
        *[c.alias(n) for n, c in named.items()],
        t.alias("current_weather"), p.alias("past_weather1"), h.alias("past_weather2"),
    )
    return stack(
        cloud_lines(base).select("id", F.lit("cloud").alias("kind"), "line"),
        weather_lines(base).select("id", F.lit("weather").alias("kind"), "line"),
    )


_RECORDS_SQL = """
    SELECT o_custkey AS id, o_orderkey AS num, o_totalprice AS value,
           CASE WHEN o_orderstatus = 'P' THEN o_orderdate ELSE date_trunc('month', o_orderdate) - INTERVAL 1 HOUR END AS ts
    FROM orders
"""
_SERIES_SQL = "SELECT c_custkey AS id, c_nationkey % 6 AS time_step_id FROM customer"


def _monthly(spark, folder):
    start = F.trunc(F.col("o_orderdate").cast("date"), "month").cast("timestamp_ntz")
    records = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("num"), F.col("o_totalprice").alias("value"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate"))
        .otherwise(start - F.make_dt_interval(hours=F.lit(1))).alias("ts"),
    )
    series = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 6).alias("time_step_id")
    )
    return records, series


@query(f"""
    WITH r AS ({_RECORDS_SQL}), s AS ({_SERIES_SQL}),
    m AS (SELECT r.*, CASE WHEN id IN (SELECT id FROM s WHERE time_step_id IN (4, 5)) THEN ts + INTERVAL 1 HOUR ELSE ts END AS t FROM r)
    SELECT id, num, value, strftime(t, '%Y-%m-%d %H:%M:%S') AS ts, t = date_trunc('month', t) AS month_start FROM m
""")
def shift_series(spark, folder):
    records, series = _monthly(spark, folder)
    shifted = shifted_series(records, series, keep_others=True)
    return shifted.select(
        "id", "num", "value", F.col("ts").cast("string").alias("ts"), is_month_start("ts").alias("month_start")
    )


@query(f"""
    WITH r AS ({_RECORDS_SQL}), s AS ({_SERIES_SQL})
    SELECT id, num, strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS ts FROM r
    WHERE id IN (SELECT id FROM s WHERE time_step_id IN (4, 5))
      AND ts + INTERVAL 1 HOUR <> date_trunc('month', ts + INTERVAL 1 HOUR)
""")
def month_start_report(spark, folder):
    records, series = _monthly(spark, folder)
    found = month_start_violations(shifted_series(records, series))
    return found.select("id", "num", F.col("ts").cast("string").alias("ts"))


_PHASE_SERIES_SQL = """
    SELECT c_custkey AS id, c_nationkey % 7 AS time_step_id, CASE WHEN c_acctbal > 1000 THEN 0 END AS nominal_offset_minutes
    FROM customer
"""
_PHASE_SQL = f"""
    WITH s AS ({_PHASE_SERIES_SQL}),
    f AS (SELECT user_id AS id, min(ts) AS t FROM events GROUP BY user_id)
    SELECT s.id, CAST(((day(t) - 1) * 1440 + hour(t) * 60 + minute(t))
                 % CASE time_step_id WHEN 1 THEN 10 WHEN 2 THEN 60 WHEN 3 THEN 1440 WHEN 6 THEN 5 END AS INTEGER) AS phase
    FROM s JOIN f ON f.id = s.id WHERE time_step_id IN (1, 2, 3, 6) AND nominal_offset_minutes IS NOT NULL
"""


def _phase_input(spark, folder):
    series = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 7).alias("time_step_id"),
        F.when(F.col("c_acctbal") > 1000, 0).alias("nominal_offset_minutes"),
    )
    chunks = series_texts(event_lines(spark, folder)).select("id", F.col("content").alias("bottom"))
    return series, chunks


@query(_PHASE_SQL)
def phase_minutes(spark, folder):
    return phases(*_phase_input(spark, folder))


@query(f"""
    WITH p AS ({_PHASE_SQL}), s AS ({_PHASE_SERIES_SQL})
    SELECT s.id, s.time_step_id, CASE WHEN p.id IS NOT NULL THEN p.phase ELSE s.nominal_offset_minutes END AS nominal_offset_minutes
    FROM s LEFT JOIN p ON p.id = s.id
""")
def phase_update(spark, folder):
    return with_phases(*_phase_input(spark, folder))


_NUMBERS_SQL = "SELECT o_custkey AS id, o_orderkey AS num, 'float' AS kind FROM orders WHERE o_orderstatus = 'O'"
_TEXTS_SQL = "SELECT o_custkey AS id, o_orderkey AS num, 'string' AS kind FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000"


def _kinds(spark, folder):
    orders = table(spark, folder, "orders")
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    columns = [F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("num")]
    numbers = orders.where(status == "O").select(*columns, F.lit("float").alias("kind"))
    texts = orders.where((status == "F") & (price > 400000)).select(*columns, F.lit("string").alias("kind"))
    return numbers, texts


@query(f"""
    WITH n AS ({_NUMBERS_SQL}), t AS ({_TEXTS_SQL})
    SELECT id, num, kind FROM n WHERE id NOT IN (SELECT id FROM t) UNION ALL SELECT id, num, kind FROM t
""")
def merge_kinds(spark, folder):
    return merged_kinds(*_kinds(spark, folder))


@query(f"""
    SELECT DISTINCT id, kind FROM ({_NUMBERS_SQL}) UNION ALL SELECT DISTINCT id, kind FROM ({_TEXTS_SQL}) ORDER BY id, kind
""")
def series_id_list(spark, folder):
    numbers, texts = _kinds(spark, folder)
    return series_ids({"float": numbers, "string": texts})
