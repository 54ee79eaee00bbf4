"""Parts of the plans that bring several tables with them, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.operators.tables import stack
from stationflow.plans import assets, national, utility
from stationflow.plans.common import Target
from stationflow.queries import query, table


def _tagged(target, columns):
    """``(table_name, columns as text)`` of some target tables; '-' stands for a column that a table lacks."""
    width = max(len(names) for names in columns.values())
    return stack(*[
        target[name].select(
            F.lit(name).alias("table_name"),
            *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(names)],
            *[F.lit("-").alias(f"c{i}") for i in range(len(names), width)],
        )
        for name, names in columns.items()
    ])


@query("""
    WITH districts AS (SELECT r_regionkey + 300 AS id, r_name AS name, r_name AS short FROM region WHERE r_regionkey > 0),
    states AS (SELECT n_nationkey + 401 AS id, n_name AS name, left(n_name, 3) AS short, n_regionkey + 300 AS parent FROM nation WHERE n_regionkey > 0),
    water AS (SELECT r_regionkey + 500 AS id, 'W ' || r_name AS name, '' AS short FROM region WHERE r_regionkey > 0),
    basins AS (
        SELECT s_suppkey + 1000 AS id, s_name AS name, CASE WHEN s_nationkey % 5 > 0 THEN s_nationkey % 5 + 500 END AS division, s_suppkey + 10 AS code
        FROM supplier WHERE s_suppkey > 0),
    sub AS (
        SELECT c_custkey + 10001400 AS id, c_name AS name, c_nationkey % 5 + 500 AS division,
               CASE WHEN c_nationkey % 3 > 0 THEN c_custkey % 40 ELSE 0 END AS code, c_custkey AS own
        FROM customer),
    codes AS (SELECT id, CAST(code AS VARCHAR) AS value FROM basins UNION ALL SELECT id, CAST(own AS VARCHAR) FROM sub),
    entities AS (
        SELECT id, name, short FROM districts UNION ALL SELECT id, name, short FROM states UNION ALL SELECT id, name, short FROM water
        UNION ALL SELECT id, name, '' FROM basins UNION ALL SELECT id, name, '' FROM sub)
    SELECT 'gentity' AS table_name, CAST(id AS VARCHAR) AS c0, name AS c1, short AS c2 FROM entities
    UNION ALL SELECT 'garea', CAST(id AS VARCHAR), '-', '-' FROM entities
    UNION ALL SELECT 'politicaldivision', CAST(id AS VARCHAR), '84', '' FROM districts
    UNION ALL SELECT 'politicaldivision', CAST(id AS VARCHAR), CAST(parent AS VARCHAR), '' FROM states
    UNION ALL SELECT 'waterdivision', CAST(id AS VARCHAR), '-', '-' FROM water
    UNION ALL SELECT 'waterbasin', CAST(id AS VARCHAR), CAST(division AS VARCHAR), NULL FROM basins
    UNION ALL SELECT 'waterbasin', CAST(sub.id AS VARCHAR), CAST(sub.division AS VARCHAR), CAST(s_suppkey + 1000 AS VARCHAR)
    FROM sub JOIN supplier ON sub.code = s_suppkey + 10 WHERE sub.code > 0
    UNION ALL SELECT 'gentityaltcode', CAST(row_number() OVER (ORDER BY id) AS VARCHAR), CAST(id AS VARCHAR), value FROM codes
""")
def area_tables(spark, folder):
    """Districts to sub-basins; rows with the sentinel key 0 are left out."""
    region, customer = table(spark, folder, "region"), table(spark, folder, "customer")
    nation_key = F.col("c_nationkey")
    source = {
        "pol_districts": region.select(F.col("r_regionkey").alias("pdid"), F.col("r_name").alias("pdname")),
        "states": table(spark, folder, "nation").select(
            (F.col("n_nationkey") + 1).alias("sttid"), F.col("n_name").alias("sttname"), F.left("n_name", F.lit(3)).alias("sttcodename"),
            F.col("n_regionkey").alias("pdid"),
        ),
        "water_districts": region.select(
            F.col("r_regionkey").alias("wtrid"), F.concat(F.lit("W "), "r_name").alias("wtrname"), F.lit("").alias("wtrcodename")
        ),
        "basins": table(spark, folder, "supplier").select(
            F.col("s_suppkey").alias("wbid"), F.col("s_name").alias("wbname"), (F.col("s_nationkey") % 5).alias("wtrid"),
            (F.col("s_suppkey") + 10).alias("wbcode"),
        ),
        "sub_basins": customer.select(
            (F.col("c_custkey") + 10_000_000).alias("wsbid"), F.col("c_name").alias("wsbname"), (nation_key % 5).alias("wtrid"),
            F.when(nation_key % 3 > 0, F.col("c_custkey") % 40).otherwise(0).alias("wbcode"), F.col("c_custkey").alias("wsbcode"),
        ),
    }
    target = Target()
    national.add_areas(source, target)
    return _tagged(target, {
        "gentity": ("id", "name", "short_name"), "garea": ("gentity_ptr_id",),
        "politicaldivision": ("garea_ptr_id", "parent_id", "code"), "waterdivision": ("garea_ptr_id",),
        "waterbasin": ("garea_ptr_id", "water_division_id", "parent_id"), "gentityaltcode": ("id", "gentity_id", "value"),
    })


@query("""
    SELECT l_orderkey + l_linenumber AS id, l_suppkey AS station_id, l_linenumber AS type_id,
           CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END AS remarks, CAST(l_shipdate AS VARCHAR) AS start_date
    FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10)
""")
def service_instruments(spark, folder):
    """The instruments of one service's stations; their keys lose two digits."""
    configured = table(spark, folder, "lineitem").select(
        ((F.col("l_orderkey") + F.col("l_linenumber")) * 100 + 7).alias("stconfigid"), (F.col("l_suppkey") * 10_000).alias("stationid"),
        F.col("l_linenumber").alias("instrtype"), F.col("l_shipdate").alias("instartdate"), F.lit(None).cast("date").alias("inenddate"),
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("notes"),
    )
    stations = table(spark, folder, "supplier").where("s_nationkey < 10").select((F.col("s_suppkey") * 10_000).alias("stationid"))
    return national.instrument_rows(configured, stations).select(
        "id", "station_id", "type_id", "remarks", F.col("start_date").cast("string").alias("start_date")
    )


@query("""
    SELECT row_number() OVER (ORDER BY page_id) AS id, page_id AS gentity_id, (SELECT max(r_regionkey) + 1 FROM region) AS file_type_id,
           page_id || '-' || row_number() OVER (ORDER BY page_id) || '.jpg' AS content, md5(html) AS digest
    FROM pages
""")
def station_images(spark, folder):
    """File rows of images, with a new file type."""
    images = table(spark, folder, "pages").select(
        (F.col("page_id") * 10_000).alias("stationid"), F.lit("2001-01-01").cast("date").alias("stimgdate"), F.col("html").cast("binary").alias("stimgdata")
    )
    types = table(spark, folder, "region").select(F.col("r_regionkey").cast("int").alias("id"), F.concat(F.lit("x/"), "r_name").alias("mime_type"))
    files, _ = national.load_images(images, images.limit(0), types)
    return files.select("id", "gentity_id", "file_type_id", "content", F.md5("bytes").alias("digest"))


@query("""
    WITH registry AS (SELECT c_custkey AS id, c_custkey AS gis_id FROM customer WHERE c_nationkey % 2 = 0),
    registered AS (
        SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS id, s_suppkey * 3 AS gis_id
        FROM supplier WHERE s_suppkey * 3 NOT IN (SELECT gis_id FROM registry)),
    bore AS (SELECT 10000000 + c_custkey AS ptr, c_custkey AS id FROM customer WHERE c_nationkey % 4 = 0),
    bare AS (SELECT id FROM registry UNION ALL SELECT id FROM registered EXCEPT SELECT id FROM bore),
    added AS (SELECT (SELECT max(n_nationkey) FROM nation) + row_number() OVER (ORDER BY id) AS ptr, id FROM bare),
    points AS (SELECT ptr FROM added UNION ALL SELECT ptr FROM bore)
    SELECT 'gisentity' AS table_name, CAST(id AS VARCHAR) AS c0, CAST(gis_id AS VARCHAR) AS c1, '1' AS c2 FROM registered
    UNION ALL SELECT 'gisentity', CAST(c_custkey AS VARCHAR), CAST(c_custkey AS VARCHAR), CAST(1 + c_nationkey % 2 AS VARCHAR) FROM customer
    UNION ALL SELECT 'gisborehole', CAST(ptr AS VARCHAR), CAST(id AS VARCHAR), '' FROM added
    UNION ALL SELECT 'gisborehole', CAST(ptr AS VARCHAR), CAST(id AS VARCHAR), 'g' FROM bore
    UNION ALL SELECT 'gisboreholespring', CAST(ptr AS VARCHAR), '-', '-' FROM points
    UNION ALL SELECT 'gpoint', CAST(ptr AS VARCHAR), 'false', '-' FROM points
    UNION ALL SELECT 'gentity', CAST(ptr AS VARCHAR), '', '-' FROM points
    UNION ALL SELECT 'gentity', CAST(n_nationkey AS VARCHAR), n_name, '-' FROM nation
""")
def borehole_parents(spark, folder):
    """Boreholes without a registry row, and the four tables above each."""
    customer, none = table(spark, folder, "customer"), F.lit(None).cast("boolean")
    key = F.col("c_custkey")
    bore = customer.where("c_nationkey % 4 = 0").select(
        (key + 10_000_000).alias("gisboreholespring_ptr_id"), key.alias("gisentity_ptr_id"), F.lit("g").alias("group"), none.alias("has_pmeter")
    )
    texts = ("short_name", "remarks", "name_alt", "short_name_alt", "remarks_alt")
    entities = table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), *[F.lit("").alias(t) for t in texts])
    target = Target({
        "gisentity": customer.select(key.alias("id"), (F.col("c_nationkey") % 2 + 1).alias("gtype_id"), key.alias("gis_id")),
        "gisborehole": bore, "gisboreholespring": bore.select(F.col("gisboreholespring_ptr_id").alias("gpoint_ptr_id")).limit(0),
        "gpoint": bore.select(F.col("gisboreholespring_ptr_id").alias("gentity_ptr_id"), none.alias("approximate")).limit(0), "gentity": entities,
    })
    assets.add_missing_boreholes(target, table(spark, folder, "supplier").select((F.col("s_suppkey") * 3).alias("id")))
    return _tagged(target, {
        "gisentity": ("id", "gis_id", "gtype_id"), "gisborehole": ("gisboreholespring_ptr_id", "gisentity_ptr_id", "group"),
        "gisboreholespring": ("gpoint_ptr_id",), "gpoint": ("gentity_ptr_id", "approximate"), "gentity": ("id", "name"),
    })


@query("""
    SELECT c_custkey AS id, CASE WHEN s_suppkey IS NULL THEN c_acctbal ELSE s_acctbal END AS capacity,
           CAST(CASE WHEN s_suppkey IS NULL THEN 1 ELSE s_nationkey END AS DOUBLE) AS storage
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey % 1000 AND c_nationkey % 5 = 3
""")
def special_fields(spark, folder):
    """The own fields of one kind of asset, set where a registry row links it to a source row."""
    customer, key = table(spark, folder, "customer"), F.col("c_custkey")
    double = lambda c: F.lit(c).cast("double")
    balance = F.col("s_acctbal").cast("double")
    source = {"treatment_plants": table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), balance.alias("capacity"), double(2).alias("peak_capacity"), F.col("s_nationkey").cast("double").alias("storage"),
        double(3).alias("overflow_stage"), double(4).alias("outlet_level"),
    )}
    registry = customer.select(
        (key + 50_000_000).alias("id"), (F.col("c_nationkey") % 5).alias("gtype_id"), (key % 1000).alias("gis_id"), F.lit(None).cast("long").alias("original_gentity_id")
    )
    plants = customer.select(
        (key + 50_000_000).alias("gisentity_ptr_id"), key.alias("gpoint_ptr_id"), F.col("c_acctbal").cast("double").alias("capacity"),
        double(0).alias("peak_capacity"), double(1).alias("storage"), double(0).alias("overflow_stage"), double(0).alias("outlet_level"),
    )
    target, asset = Target({"gisentity": registry, "gisrefinery": plants}), assets.assets()["refineries"]
    links = assets.link_assets(target["gisrefinery"], target["gisentity"], asset.pointer, asset.link, asset.kind)
    assets.set_details(target, asset, source, links)
    return target["gisrefinery"].select(F.col("gpoint_ptr_id").alias("id"), "capacity", "storage")


_EXTENSION_SQL = "CASE l_linenumber " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in values.FILE_EXTENSIONS.items()) + " END"


@query(f"""
    WITH files AS (
        SELECT l_orderkey + 1000 AS entity, l_linenumber AS num, min({_EXTENSION_SQL}) AS extension, min(l_shipmode) AS name
        FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_shipmode FROM lineitem GROUP BY ALL) JOIN orders ON o_orderkey = l_orderkey
        WHERE o_orderstatus = 'O' GROUP BY ALL)
    SELECT 'gentityevent' AS table_name, CAST(row_number() OVER (ORDER BY o_orderkey) AS VARCHAR) AS c0, CAST(o_orderkey + 1000 AS VARCHAR) AS c1,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS c2, '' AS c3
    FROM orders
    UNION ALL SELECT 'gentityfile', CAST(row_number() OVER (ORDER BY entity, num) AS VARCHAR), CAST(entity AS VARCHAR), name,
           'gentityfile/kept_' || entity || '-' || num || '.' || extension
    FROM files
    UNION ALL SELECT 'filetype', CAST(r_regionkey AS VARCHAR), r_name, '', '-' FROM region
""")
def events_and_files(spark, folder):
    """Events, file types, and the files of the entities that are loaded."""
    orders, none = table(spark, folder, "orders"), F.lit(None).cast("string")
    media = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("multimedia_name"))
    source = {
        "gentities_events": orders.select(
            F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("event_date"), F.lit(1).alias("event_type"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("event_user"), none.alias("report"), none.alias("report_en"),
        ),
        "ftypes": table(spark, folder, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("descr"), none.alias("descr_en"), none.alias("mime_type")),
        "gentities_multimedia": media.select(
            F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("num"), "multimedia_name", none.alias("multimedia_name_en"),
            none.alias("remarks"), none.alias("remarks_en"), F.lit("2000-01-01").cast("date").alias("mdate"), F.col("l_linenumber").alias("ftype"),
        ),
    }
    target = Target({"gentity": orders.where("o_orderstatus = 'O'").select((F.col("o_orderkey") + 1000).alias("id"))})
    utility.add_events_and_files(target, source, "kept_")
    return _tagged(target, {
        "gentityevent": ("id", "gentity_id", "user", "report"), "gentityfile": ("id", "gentity_id", "descr", "content"), "filetype": ("id", "descr", "mime_type"),
    })
