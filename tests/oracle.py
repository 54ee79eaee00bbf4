"""Run a query and its SQL counterpart and compare rows as bags."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        v = float(v)
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """(same, number of Spark rows, example differences)."""
    spark_columns, spark_bag = bag(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    sql_columns, sql_bag = bag(names, cursor.fetchall())
    if spark_columns != sql_columns:
        return False, sum(spark_bag.values()), (spark_columns, sql_columns)
    extra = list((spark_bag - sql_bag).items())[:2], list((sql_bag - spark_bag).items())[:2]
    return spark_bag == sql_bag, sum(spark_bag.values()), extra
