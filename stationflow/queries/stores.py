"""Loads into a store: all at once, by key, with sequences of their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.operators.series import canonical
from stationflow.operators.updates import new
from stationflow.plans import utility
from stationflow.plans.common import run_into
from stationflow.queries import query, table
from stationflow.session import work_dir
from stationflow.sinks.store import IntegrityError, Store


@query("""
    SELECT s_suppkey AS id, s_name AS name, '' AS remarks, 1 AS version,
           (SELECT count(*) FROM supplier WHERE s_suppkey % 5 = 0) AS broken,
           (SELECT count(*) FROM supplier WHERE s_suppkey % 5 = 0) AS tried
    FROM supplier WHERE s_nationkey < 13
""")
def load_rolled_back(spark, folder):
    """A load, a broken one and a dry run: the store is as the first left it."""
    place = work_dir(spark, "rolled-back")
    services = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("descr"), F.lit("S").alias("short_descr"),
        F.lit(None).cast("string").alias("descr_en"), F.lit(None).cast("string").alias("short_descr_en"), "s_nationkey",
    )
    run_into(spark, place, lambda load: utility.organization_tables(services.where("s_nationkey < 13")))

    def broken(load):
        tables = utility.organization_tables(services)
        return tables | {"lentity": tables["lentity"].where("id % 5 <> 0")}

    tried = run_into(spark, place, broken, dry_run=True)
    try:
        run_into(spark, place, broken)
        found = {}
    except IntegrityError as error:
        found = error.violations
    store = Store(spark, place)
    joined = store.table("organization").join(store.table("lentity"), F.col("lentity_ptr_id") == F.col("id"))
    return joined.select(
        "id", "name", "remarks", F.lit(store.manifest().version).alias("version"),
        *[F.lit(v.get("organization.lentity_ptr_id", 0)).cast("long").alias(n) for n, v in (("broken", found), ("tried", tried))],
    )


@query("""
    WITH first AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS id FROM customer WHERE c_nationkey < 10),
    later AS (
        SELECT c_custkey, (SELECT count(*) FROM first) + 100 + row_number() OVER (ORDER BY c_custkey) AS id
        FROM customer WHERE c_nationkey >= 10)
    SELECT c_custkey, id FROM first WHERE id <= (SELECT count(*) FROM first) - 7
    UNION ALL SELECT c_custkey, id FROM later
""")
def ids_after_deletion(spark, folder):
    """Ids of deleted rows, and ids reserved for other rows, are not given again; those of a discarded load are."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    store = Store(spark, work_dir(spark, "sequence"))
    with store.begin() as load:
        load.put("person", load.number("person", customers.where("c_nationkey < 10"), ["c_custkey"], unique=True))
        load.commit()
    with store.begin() as load:
        last = load.reserve("person", 100) - 1
        load.delete("person", "id", load["person"].where(F.col("id") > last - 7))
        load.commit()
    with store.begin() as load:
        load.reserve("person", 1_000_000)
    with store.begin() as load:
        rows = load.number("person", customers.where("c_nationkey >= 10"), ["c_custkey"], unique=True)
        load.put("person", load["person"].unionByName(rows))
        load.commit()
    return store.table("person").select("c_custkey", "id")


@query("""
    WITH changes AS (
        SELECT l_orderkey, min(l_extendedprice) AS price FROM lineitem WHERE l_quantity > 40 GROUP BY l_orderkey)
    SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN price IS NULL THEN o_totalprice ELSE price END AS price
    FROM orders LEFT JOIN changes ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'
    UNION ALL SELECT -1 - c_custkey, 'new', c_acctbal FROM customer
""")
def merged_orders(spark, folder):
    """Rows updated, added and deleted by key in a stored table of many buckets."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")
    )
    changes = table(spark, folder, "lineitem").where("l_quantity > 40").select(
        F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("price")
    )
    added = table(spark, folder, "customer").select((-1 - F.col("c_custkey")).alias("id"), F.lit("new").alias("status"), F.col("c_acctbal").alias("price"))
    store = Store(spark, work_dir(spark, "merged"))
    with store.begin() as load:
        load.replace("orders", "id", orders, bucket_rows=orders.count() // 32 + 1)
        load.commit()
    with store.begin() as load:
        load.merge("orders", "id", changes, {"price": new("price")}, order=["price"], insert=False)
        load.merge("orders", "id", added, {"price": new("price")})
        load.delete("orders", "id", orders.where("status = 'P'"))
        load.commit()
    return store.table("orders")


@query("""
    SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CASE WHEN event_id % 97 = 0 THEN -1.0 ELSE value END AS value,
           CASE WHEN event_id % 97 = 0 THEN 'again' ELSE 'first' END AS flags, TRUE AS bounded
    FROM events
""")
def grown_series(spark, folder):
    """A store that grows fifty-fold in three loads; then some series are replaced. No bucket passes the bound."""
    events = table(spark, folder, "events")
    most = events.count() // 50 + 1  # what the first load brings
    store = Store(spark, work_dir(spark, "grown"))
    first = canonical(events, "event_id", "ts", F.col("value"), F.lit("first"))
    again = canonical(events.where("event_id % 97 = 0"), "event_id", "ts", F.lit(-1.0), F.lit("again"))
    for rows in (first.where("id % 50 = 0"), first.where("id % 50 BETWEEN 1 AND 9"), first.where("id % 50 >= 10"), again):
        with store.begin() as load:
            load.replace("records", "id", rows, bucket_rows=most)
            load.commit()
    largest = store.buckets("records").agg(F.max("rows")).first()[0]
    return store.table("records").select(
        F.col("id").cast("long").alias("id"), F.date_trunc("second", "ts").cast("timestamp_ntz").cast("string").alias("ts"),
        "value", "flags", F.lit((largest or 0) <= most).alias("bounded"),
    )
