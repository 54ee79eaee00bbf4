"""Table splits, joins, updates, keys and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.functions.text import word
from stationflow.operators.ids import assign_ids, next_id, next_ids
from stationflow.operators.joins import (
    carry_records,
    left_to_bridge,
    left_with_fixed,
    link_assets,
    match_names,
    match_time_steps,
    matching_parents,
    members,
    not_in,
)
from stationflow.operators.quality import fk_report
from stationflow.operators.tables import (
    append,
    copy_lookup,
    literal_table,
    stack,
    tagged_rows,
    unpivot_codes,
    with_old_id,
)
from stationflow.operators.updates import (
    get_or_create,
    insert_missing,
    load_once,
    missing_keys,
    new,
    update_from,
    update_where_in,
)
from stationflow.queries import query, table
from stationflow.sources.tables import rows


@query("""
    SELECT 'gentity' AS table_name, 300 + r_regionkey AS id, r_name AS name, CAST(NULL AS BIGINT) AS parent_id FROM region
    UNION ALL SELECT 'garea', 300 + r_regionkey, NULL, NULL FROM region
    UNION ALL SELECT 'division', 300 + r_regionkey, NULL, 84 FROM region
    UNION ALL SELECT 'gentity', 400 + n_nationkey, n_name, NULL FROM nation
    UNION ALL SELECT 'garea', 400 + n_nationkey, NULL, NULL FROM nation
    UNION ALL SELECT 'division', 400 + n_nationkey, NULL, 300 + n_regionkey FROM nation
    UNION ALL SELECT 'gentity', 1000 + c_custkey, c_name, NULL FROM customer
    UNION ALL SELECT 'gpoint', 1000 + c_custkey, NULL, NULL FROM customer
    UNION ALL SELECT 'station', 1000 + c_custkey, NULL, 400 + c_nationkey FROM customer
""")
def class_split(spark, folder):
    def specs(key, name, parent, kinds):
        key = key.cast("long")
        none = F.lit(None).cast("string")
        no_parent = F.lit(None).cast("long")
        area, division = kinds
        return {
            "gentity": {"id": key, "name": name, "parent_id": no_parent},
            area: {"id": key, "name": none, "parent_id": no_parent},
            division: {"id": key, "name": none, "parent_id": parent.cast("long")},
        }

    region, nation, customer = (table(spark, folder, t) for t in ("region", "nation", "customer"))
    pieces = [
        tagged_rows(region, specs(F.col("r_regionkey") + 300, "r_name", F.lit(84), ("garea", "division"))),
        tagged_rows(nation, specs(F.col("n_nationkey") + 400, "n_name", F.col("n_regionkey") + 300, ("garea", "division"))),
        tagged_rows(customer, specs(F.col("c_custkey") + 1000, "c_name", F.col("c_nationkey") + 400, ("gpoint", "station"))),
    ]
    return stack(*pieces)


@query("""
    SELECT doc_id + 1000 AS gentity_id, 1 AS type_id, CAST(quality AS VARCHAR) AS value FROM labels WHERE quality IS NOT NULL
    UNION ALL SELECT doc_id + 1000, 2, CAST(toxic AS VARCHAR) FROM labels WHERE toxic IS NOT NULL
    UNION ALL SELECT doc_id + 1000, 3, CAST(nullif(quality, 0) AS VARCHAR) FROM labels WHERE nullif(quality, 0) IS NOT NULL
""")
def unpivot_codes_labels(spark, folder):
    labels = table(spark, folder, "labels").withColumn("other", F.nullif("quality", F.lit(0)))
    return unpivot_codes(labels, F.col("doc_id") + 1000, {1: "quality", 2: "toxic", 3: "other"})


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_name <> ''")
def service_rows(spark, folder):
    return rows(
        spark,
        "SELECT c_custkey, c_name, c_acctbal FROM {stations} WHERE c_mktsegment = :service AND c_name <> ''",
        {"stations": table(spark, folder, "customer")},
        service="BUILDING",
    )


@query("""
    SELECT 'in' AS case_name, o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'not in', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'not in with null', o_orderkey FROM orders
        WHERE o_orderkey NOT IN (SELECT nullif(l_orderkey, 1) FROM lineitem)
    UNION ALL SELECT 'null not in', o_orderkey FROM orders
        WHERE nullif(o_orderkey, 5) NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'not in nothing', o_orderkey FROM orders
        WHERE nullif(o_orderkey, 5) NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity < 0)
""")
def join_semi_anti(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.nullif("o_orderkey", F.lit(5)).alias("some_key"))
    lineitem = table(spark, folder, "lineitem").select(
        "l_orderkey", F.nullif("l_orderkey", F.lit(1)).alias("null_key"), "l_quantity"
    )
    cases = {
        "in": members(orders, "o_orderkey", lineitem, "l_orderkey"),
        "not in": not_in(orders, "o_orderkey", lineitem, "l_orderkey"),
        "not in with null": not_in(orders, "o_orderkey", lineitem, "null_key"),
        "null not in": not_in(orders, "some_key", lineitem, "l_orderkey"),
        "not in nothing": not_in(orders, "some_key", lineitem.where(F.col("l_quantity") < 0), "l_orderkey"),
    }
    return stack(*[df.select(F.lit(name).alias("case_name"), "o_orderkey") for name, df in cases.items()])


@query("""
    SELECT p.p_partkey, b.l_suppkey AS unit_id
    FROM part p LEFT JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_quantity > 45) b ON b.l_partkey = p.p_partkey
""")
def join_bridge_left(spark, folder):
    bridge = table(spark, folder, "lineitem").where(F.col("l_quantity") > 45).select("l_partkey", "l_suppkey").distinct()
    parts = table(spark, folder, "part").select("p_partkey")
    return left_to_bridge(parts, "p_partkey", bridge, "l_partkey", "l_suppkey", "unit_id")


@query("""
    SELECT d.doc_id, g.quality AS name FROM documents d LEFT JOIN labels g ON g.toxic = 1 AND g.doc_id = d.doc_id
""")
def join_fixed_left(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id")
    return left_with_fixed(documents, "doc_id", table(spark, folder, "labels"), "doc_id", "quality", {"toxic": 1}, "name")


@query("""
    WITH t AS (
        SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 3 WHEN 'signup' THEN 1 END AS unit,
               CASE user_id % 6 WHEN 0 THEN 10 WHEN 1 THEN 60 WHEN 2 THEN 1440 WHEN 3 THEN 1 WHEN 4 THEN 12 ELSE 7 END AS len
        FROM events),
    st AS (SELECT * FROM (VALUES (1, 10, 0), (2, 60, 0), (3, 1440, 0), (4, 0, 1), (5, 0, 12)) v(id, length_minutes, length_months))
    SELECT t.event_id, st.id AS time_step_id, CASE WHEN st.length_months > 0 THEN -60 ELSE 0 END AS actual_offset_minutes,
           st.length_months AS actual_offset_months
    FROM t LEFT JOIN st ON (t.unit = 1 AND st.length_minutes = t.len AND st.length_months = 0)
                        OR (t.unit = 2 AND st.length_minutes = 0 AND st.length_months = t.len)
""")
def join_disjunctive(spark, folder):
    kind = F.col("event_type")
    unit = F.when(kind.isin("view", "signup"), 1).when(kind == "click", 2).when(kind == "error", 3)
    place = F.col("user_id") % 6
    length = F.lit(7)
    for i, v in enumerate((10, 60, 1440, 1, 12)):
        length = F.when(place == i, v).otherwise(length)
    events = table(spark, folder, "events").select("event_id", unit.alias("unit"), length.alias("len"))
    steps = literal_table(
        spark, values.LOCAL_TIME_STEPS, "id int, descr string, descr_alt string, length_minutes int, length_months int"
    )
    return match_time_steps(events, "unit", "len", steps).select(
        "event_id", "time_step_id",
        F.when(F.col("length_months") > 0, -60).otherwise(0).alias("actual_offset_minutes"),
        F.col("length_months").alias("actual_offset_months"),
    )


@query("""
    WITH p AS (
        SELECT split_part(p_name, ' ', 1) AS last_name, split_part(p_name, ' ', 2) AS first_name, min(p_partkey) AS id
        FROM part WHERE p_name <> '' GROUP BY ALL)
    SELECT s.p_partkey AS station_id, p.id AS person_id
    FROM part s JOIN p ON split_part(s.p_name, ' ', 1) = p.last_name AND split_part(s.p_name, ' ', 2) = p.first_name
""")
def join_name_keys(spark, folder):
    part = table(spark, folder, "part")
    people = part.where(F.col("p_name") != "").select(
        F.col("p_partkey").alias("id"), word("p_name", 1).alias("last_name"), word("p_name", 2).alias("first_name")
    )
    return match_names(part, "p_name", people, "last_name", "first_name", one_per_name=True).select(
        F.col("p_partkey").alias("station_id"), "person_id"
    )


@query("""
    SELECT o.o_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice, c.c_custkey + 1000 AS gentity_id, n.n_name
    FROM lineitem l, orders o, customer c, nation n
    WHERE l.l_orderkey = o.o_orderkey AND o.o_custkey + 1000 = c.c_custkey + 1000 AND c.c_nationkey = n.n_nationkey
""")
def join_chain(spark, folder):
    lineitem, orders, customer, nation = (table(spark, folder, t) for t in ("lineitem", "orders", "customer", "nation"))
    entities = customer.select((F.col("c_custkey") + 1000).alias("gentity_id"), "c_nationkey")
    keyed = orders.select("o_orderkey", (F.col("o_custkey") + 1000).alias("gentity_id"))
    return (
        lineitem.join(keyed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(entities, "gentity_id")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "gentity_id", "n_name")
    )


@query("""
    SELECT h.o_orderkey, o.n_name AS name
    FROM orders h, nation o, customer b
    WHERE h.o_orderkey IN (SELECT a.o_orderkey FROM orders a WHERE a.o_custkey = b.c_custkey)
      AND o.n_nationkey = b.c_nationkey
""")
def asset_link(spark, folder):
    orders, customer, nation = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    assets = orders.select(F.col("o_custkey").alias("gisentity_ptr_id"), F.col("o_orderkey").alias("gpoint_ptr_id"))
    entities = customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("gis_id"))
    links = link_assets(assets, entities, "gpoint_ptr_id", "gis_id")
    return links.join(nation, F.col("source_id") == F.col("n_nationkey")).select(
        F.col("entity_id").alias("o_orderkey"), F.col("n_name").alias("name")
    )


@query("""
    WITH s AS (
        SELECT o_custkey, arg_min(struct_pack(status := nullif(o_orderstatus, 'F'), price := o_totalprice), o_orderkey) AS r
        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
    SELECT c_custkey, CASE WHEN s.r IS NULL THEN c_mktsegment ELSE s.r.status END AS c_mktsegment,
           CASE WHEN s.r IS NULL THEN c_acctbal ELSE c_acctbal + s.r.price END AS c_acctbal
    FROM customer LEFT JOIN s ON s.o_custkey = c_custkey
""")
def update_from_orders(spark, folder):
    urgent = table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.nullif("o_orderstatus", F.lit("F")).alias("status")
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return update_from(
        customer, urgent, {"c_custkey": "o_custkey"},
        {"c_mktsegment": new("status"), "c_acctbal": F.col("c_acctbal") + new("o_totalprice")},
        order=["o_orderkey"],
    )


@query("""
    SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN '' ELSE source END AS drawing_file
    FROM documents
""")
def update_membership(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.col("source").alias("drawing_file"))
    good = table(spark, folder, "labels").where(F.col("quality") == 1)
    return update_where_in(documents, "doc_id", good, "doc_id", {"drawing_file": F.lit("")})


@query("""
    WITH missing AS (SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + (SELECT max(l_orderkey) FROM lineitem) AS id FROM missing
""")
def insert_missing_orders(spark, folder):
    orders, lineitem = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    missing = missing_keys(orders, "o_orderkey", lineitem, "l_orderkey").withColumnRenamed("l_orderkey", "o_orderkey")
    return assign_ids(missing, ["o_orderkey"], next_id(lineitem, "l_orderkey"), unique=True)


@query("""
    SELECT o_orderstatus, o_orderpriority, row_number() OVER (ORDER BY o_orderstatus, o_orderpriority) + 99 AS id FROM orders
""")
def assign_ids_copies(spark, folder):
    return assign_ids(
        table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority"),
        ["o_orderstatus", "o_orderpriority"], 100,
    )


@query("""
    SELECT doc_id, quality, toxic FROM labels
    UNION ALL SELECT doc_id, 0, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def get_or_create_labels(spark, folder):
    wanted = table(spark, folder, "documents").select("doc_id", F.lit(0).alias("quality"))
    return get_or_create(table(spark, folder, "labels"), "doc_id", wanted)


@query("""
    SELECT 'filled' AS case_name, o_orderkey FROM orders WHERE (SELECT count(*) FROM customer) = 0
    UNION ALL SELECT 'empty', o_orderkey FROM orders WHERE (SELECT count(*) FROM customer WHERE c_acctbal IS NULL) = 0
""")
def load_once_orders(spark, folder):
    orders, customer = table(spark, folder, "orders").select("o_orderkey"), table(spark, folder, "customer")
    filled = load_once(customer, orders).select(F.lit("filled").alias("case_name"), "o_orderkey")
    empty = load_once(customer.where(F.col("c_acctbal").isNull()), orders).select(F.lit("empty").alias("case_name"), "o_orderkey")
    return stack(filled, empty)


@query("""
    SELECT 'documents.doc_id' AS reference, count(*) AS violations FROM documents d
        WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    UNION ALL SELECT 'lineitem.l_orderkey', count(*) FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
    UNION ALL SELECT 'orders.some_key', count(*) FROM orders
        WHERE nullif(o_orderkey, 5) IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = nullif(o_orderkey, 5))
""")
def fk_violations_report(spark, folder):
    documents, labels, lineitem, orders = (
        table(spark, folder, t) for t in ("documents", "labels", "lineitem", "orders")
    )
    some = orders.select(F.nullif("o_orderkey", F.lit(5)).alias("some_key"))
    return fk_report(
        [
            ("documents.doc_id", documents, "doc_id", labels, "doc_id"),
            ("lineitem.l_orderkey", lineitem, "l_orderkey", orders, "o_orderkey"),
            ("orders.some_key", some, "some_key", lineitem, "l_orderkey"),
        ]
    )


_KEYS = [
    ("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"), ("orders", "o_orderkey"),
    ("events", "event_id"), ("documents", "doc_id"), ("nation", "n_nationkey"),
]


@query(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, coalesce(max({k}), 0) + 1 AS next_id FROM {t}" for t, k in _KEYS)
    + " UNION ALL SELECT 'empty', coalesce(max(l_orderkey), 0) + 1 FROM lineitem WHERE l_quantity < 0"
)
def next_ids_tables(spark, folder):
    tables = {t: table(spark, folder, t).select(F.col(k).alias("id")) for t, k in _KEYS}
    lineitem = table(spark, folder, "lineitem")
    tables["empty"] = lineitem.where(F.col("l_quantity") < 0).select(F.col("l_orderkey").alias("id"))
    return next_ids(tables)


@query("""
    SELECT o_custkey, count(CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30) THEN 1 END) AS count
    FROM orders GROUP BY o_custkey
""")
def count_parents_with_children(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    large = table(spark, folder, "lineitem").where(F.col("l_quantity") > 30)
    return matching_parents(orders, ["o_orderkey"], large, ["l_orderkey"], ["o_custkey"])


@query("""
    SELECT s.c_custkey + 5000 AS id, coalesce(nullif(v.role, 'user'), '') AS top, v.text AS middle, v.text AS bottom
    FROM conversations v, customer s
    WHERE v.turn = 0 AND s.c_mktsegment <> 'BUILDING' AND v.conv_id = s.c_custkey
""")
def carry_chunks(spark, folder):
    chunks = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("id"), F.col("turn").alias("num"), F.nullif("role", F.lit("user")).alias("top"),
        F.col("text").cast("binary").alias("middle"), F.col("text").alias("bottom"),
    )
    customer = table(spark, folder, "customer")
    series = with_old_id(customer, "c_custkey").select(
        (F.col("c_custkey") + 5000).alias("id"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("old_id")).alias("old_id"),
    )
    carried = carry_records(chunks, series, old_id="old_id", first_chunk_only=True)
    return carried.withColumn("middle", F.col("middle").cast("string"))


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT s_suppkey + 1000000, s_name, s_nationkey, NULL, NULL FROM supplier
""")
def append_rows(spark, folder):
    added = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1000000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey")
    )
    return append(table(spark, folder, "customer"), added)


@query("""
    SELECT p_partkey AS id, coalesce(nullif(p_type, 'ECONOMY'), '') AS descr, coalesce(nullif(p_name, 'small ring'), '') AS descr_alt,
           p_brand AS symbol
    FROM part
""")
def lookup_copy(spark, folder):
    lookup = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.nullif("p_type", F.lit("ECONOMY")).alias("descr"),
        F.nullif("p_name", F.lit("small ring")).alias("descr_en"), "p_brand",
    )
    return copy_lookup(lookup, symbol="p_brand")


@query("""
    SELECT doc_id, quality, toxic FROM labels
    UNION ALL SELECT doc_id, -1, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def insert_missing_parents(spark, folder):
    return insert_missing(
        table(spark, folder, "documents"), "doc_id", table(spark, folder, "labels"), "doc_id", {"quality": F.lit(-1)}
    )
