"""Parts of the plans, on the driver's tables in the shape of the plans' sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.operators.tables import stack
from stationflow.plans import assets, national, utility, weather
from stationflow.queries import query, table
from stationflow.queries.columns import STEP_TABLE_SQL


@query("""
    SELECT 'lentity' AS table_name, s_suppkey AS id, '' AS remarks, CAST(NULL AS VARCHAR) AS name, NULL AS acronym, NULL AS name_alt
    FROM supplier
    UNION ALL SELECT 'organization', s_suppkey, NULL, coalesce(s_name, ''),
           CASE WHEN s_acctbal > 3000 THEN 'S' || s_nationkey ELSE '' END, '' FROM supplier
""")
def organization_load(spark, folder):
    services = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("descr"),
        F.when(F.col("s_acctbal") > 3000, F.concat(F.lit("S"), F.col("s_nationkey").cast("string"))).alias("short_descr"),
        F.lit(None).cast("string").alias("descr_en"), F.lit(None).cast("string").alias("short_descr_en"),
    )
    tables = utility.organization_tables(services)
    both = stack(
        tables["lentity"].withColumn("table_name", F.lit("lentity")),
        tables["organization"].withColumnRenamed("lentity_ptr_id", "id").withColumn("table_name", F.lit("organization")),
    )
    return both.select("table_name", "id", "remarks", "name", "acronym", "name_alt")


_PREFECTURE = "CASE prefecture " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.PREFECTURE_DIVISIONS.items()) + " END"


@query(f"""
    WITH g AS (
        SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal > 2000 THEN c_mktsegment || ' ' || repeat('x', 60) END AS descr,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS remarks, c_nationkey AS prefecture,
               CASE WHEN c_acctbal > 5000 THEN c_name END AS location, lower(c_mktsegment) AS municipality,
               c_acctbal > 0 AS has_details, c_acctbal < 9000 AS has_point, c_nationkey AS basin,
               CASE WHEN c_nationkey > 12 THEN 'Observer ' || c_nationkey END AS observer,
               CASE WHEN c_nationkey < 20 THEN 'stations' WHEN c_nationkey < 23 THEN 'basins' ELSE 'lines' END AS sub
        FROM customer),
    e AS (
        SELECT id + 1000 AS id, left(name, 200) AS name, coalesce(left(descr, 50), '') AS short_name,
               coalesce(remarks, '') || CASE WHEN has_details THEN chr(10) || CASE WHEN location IS NULL THEN ''
                    ELSE 'Τοποθεσία: ' || location END || chr(10) || 'Δήμος: ' || municipality ELSE '' END
               || CASE WHEN sub = 'stations' THEN chr(10) || CASE WHEN observer IS NULL THEN '' ELSE 'Παρατηρητής: ' || observer END
                  ELSE '' END AS remarks,
               CASE WHEN has_details THEN chr(10) || chr(10) || 'Municipality: ' || municipality ELSE '' END
               || CASE WHEN sub = 'stations' THEN chr(10) ELSE '' END AS remarks_alt,
               CASE WHEN has_details THEN {_PREFECTURE} END AS political_division_id,
               CASE WHEN has_point THEN CAST(basin + 1000 AS BIGINT) END AS water_basin_id
        FROM g WHERE sub IN ('stations', 'basins'))
    SELECT e.*, CASE WHEN n_nationkey IS NOT NULL THEN n_regionkey + 500 END AS water_division_id
    FROM e LEFT JOIN nation ON n_nationkey + 1000 = e.water_basin_id
""")
def station_entities(spark, folder):
    customer = table(spark, folder, "customer")
    key = F.col("c_custkey").alias("id")
    segment, balance, nation_key = F.col("c_mktsegment"), F.col("c_acctbal"), F.col("c_nationkey")
    none = F.lit(None).cast("string")
    kind = F.when(nation_key < 20, "stations").when(nation_key < 23, "basins").otherwise("lines")
    source = {
        "gentities": customer.select(
            key, F.col("c_name").alias("name"),
            F.when(balance > 2000, F.concat(segment, F.lit(" " + "x" * 60))).alias("descr"),
            F.when(segment != "BUILDING", segment).alias("remarks"),
            none.alias("name_en"), none.alias("descr_en"), none.alias("remarks_en"), kind.alias("terminal_subtable"),
        ),
        "gentities_real": customer.where(balance > 0).select(
            key, nation_key.alias("prefecture"), F.when(balance > 5000, F.col("c_name")).alias("location"),
            none.alias("location_en"), F.lower("c_mktsegment").alias("municipality"), F.lower("c_mktsegment").alias("municipality_en"),
        ),
        "gpoints": customer.where(balance < 9000).select(key, nation_key.cast("long").alias("basin")),
        "stations": customer.where(kind == "stations").select(
            key, F.when(nation_key > 12, F.concat(F.lit("Observer "), nation_key.cast("string"))).alias("observer"),
            none.alias("observer_en"),
        ),
        "basins": table(spark, folder, "nation").select(
            F.col("n_nationkey").cast("long").alias("id"), F.col("n_regionkey").alias("water_district")
        ),
    }
    entities = utility.entity_rows(source["gentities"])
    wide = entities.withColumn("water_basin_id", F.col("water_basin_id").cast("long"))
    return utility.completed_entities(wide, source).select(
        "id", "name", "short_name", "remarks", "remarks_alt", "political_division_id", "water_basin_id", "water_division_id"
    )


_SERIES_SQL = """
    SELECT l_orderkey AS id, l_suppkey AS gentity, l_linenumber AS var, CASE WHEN l_discount > 0.05 THEN l_linenumber END AS unit,
           CASE WHEN l_tax > 0.04 THEN l_returnflag END AS name, l_linenumber AS ttype, l_linenumber AS tstep,
           l_linenumber AS var_type, CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS strict,
           CASE l_linestatus WHEN 'O' THEN TRUE END AS hydro, CASE WHEN l_quantity > 20 THEN l_linenumber END AS toffset,
           l_quantity > 40 AS synth, l_partkey AS instrument
    FROM lineitem
"""


def _series_source(spark, folder):
    number, none = F.col("l_linenumber"), F.lit(None).cast("string")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("gentity"), number.alias("var"),
        F.when(F.col("l_discount") > 0.05, number).alias("unit"),
        F.when(F.col("l_tax") > 0.04, F.col("l_returnflag")).alias("name"), none.alias("name_en"),
        F.lit(2).alias("precision"), none.alias("remarks"), none.alias("remarks_en"), number.alias("ttype"),
        number.alias("tstep"), number.alias("var_type"),
        F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False).alias("tstep_strict"),
        F.when(F.col("l_linestatus") == "O", True).alias("hydrological_year"),
        F.when(F.col("l_quantity") > 20, number).alias("toffset"),
        (F.col("l_quantity") > 40).alias("synth"), F.col("l_partkey").alias("instrument"),
    )


@query(f"""
    SELECT id, gentity + 1000 AS gentity_id, var AS variable_id, coalesce(unit, 1001) AS unit_of_measurement_id,
           coalesce(name, '') AS name, '' AS name_alt, 2 AS precision, 1 AS time_zone_id,
           chr(10) || 'Τύπος: ' || ['Πρωτογενής', 'Επεξεργασμένη'][ttype] AS remarks,
           chr(10) || 'Type: ' || ['Raw data', 'Processed data'][ttype] AS remarks_alt,
           instrument AS instrument_id, t.target AS time_step_id, v.kind AS interval_type_id,
           0 * nullif(CAST(strict AS INTEGER), 0) AS nominal_offset_minutes,
           9 * nullif(CAST(strict AS INTEGER), 0) * coalesce(CAST(hydro AS INTEGER), 0) AS nominal_offset_months,
           coalesce(toffset, 0) AS actual_offset_minutes, coalesce(t.months, 0) AS actual_offset_months
    FROM ({_SERIES_SQL}) LEFT JOIN {STEP_TABLE_SQL} t(code, target, kind, months) ON t.code = tstep
         LEFT JOIN {STEP_TABLE_SQL} v(code, target, kind, months) ON v.code = var_type
    WHERE synth = FALSE AND ttype < 3 AND gentity + 1000 IN (SELECT s_suppkey + 1000 FROM supplier WHERE s_acctbal > 0)
""")
def series_metadata(spark, folder):
    suppliers = table(spark, folder, "supplier").where(F.col("s_acctbal") > 0)
    return utility.series_rows(_series_source(spark, folder), suppliers.select((F.col("s_suppkey") + 1000).alias("id")))


_BRIDGE = ", ".join(f"({u}, {v})" for u, variables in values.UNIT_VARIABLES.items() for v in variables)


@query(f"""
    SELECT o_orderkey AS id, CASE WHEN o_orderkey = 0 THEN 501030 ELSE (o_orderkey + 5010150001) // 10000 END AS gentity_id,
           o_custkey AS variable_id, uv.u AS unit_of_measurement_id, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS remarks,
           o_custkey // 100 AS instrument_id, CASE WHEN o_custkey BETWEEN 1 AND 7 THEN o_custkey END AS time_step_id,
           CASE WHEN o_custkey BETWEEN 1 AND 7 THEN 0 END AS actual_offset_minutes
    FROM orders LEFT JOIN (VALUES {_BRIDGE}) uv(u, v) ON uv.v = o_custkey
""")
def national_series(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderkey") + 5010150001).alias("geoinfoid"), F.col("o_custkey").alias("varid"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("comments"),
        F.col("o_custkey").alias("instrid"), F.col("o_custkey").alias("timeresid"),
    )
    rows = national.series_rows(orders, national.unit_variables(spark, values.UNIT_VARIABLES))
    return rows.select(
        "id", "gentity_id", "variable_id", "unit_of_measurement_id", "remarks", "instrument_id", "time_step_id", "actual_offset_minutes"
    )


@query("""
    WITH s AS (SELECT *, CASE WHEN c_custkey = 501015 THEN 501030 ELSE c_custkey END AS id FROM customer)
    SELECT table_name, id, a, b FROM (
        SELECT 'gentity' AS table_name, id, CASE WHEN c_nationkey > 0 THEN c_nationkey + 400 END AS a,
               coalesce(nullif(c_mktsegment, 'BUILDING'), 'Anonymous') AS b FROM s
        UNION ALL SELECT 'gpoint', id, CASE WHEN c_acctbal <> 0 THEN 2100 END, CAST(c_acctbal AS VARCHAR) FROM s
        UNION ALL SELECT 'station', id, CASE WHEN c_nationkey > 0 THEN c_nationkey ELSE 1 END,
               CASE WHEN c_nationkey = 1 THEN 'true' ELSE 'false' END FROM s)
""")
def national_stations(spark, folder):
    balance, nation_key = F.col("c_acctbal"), F.col("c_nationkey")
    none = F.lit(None).cast("string")
    stations = table(spark, folder, "customer").select(
        (F.col("c_custkey") * 10000 + 1).alias("stationid"), F.lit(1).alias("srvid"), nation_key.alias("wbid"), nation_key.alias("wtrid"),
        nation_key.alias("sttid"), nation_key.alias("stcatid"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("stationname"),
        none.alias("comments"), balance.alias("x"), balance.alias("y"), balance.alias("altitude"), none.alias("phi"),
        none.alias("lamda"), nation_key.alias("st_isactiv"), F.lit(None).cast("date").alias("startdate"), F.lit(None).cast("date").alias("enddate"),
    )
    tables = national.station_tables(stations)
    return stack(
        tables["gentity"].select(
            F.lit("gentity").alias("table_name"), "id", F.col("political_division_id").alias("a"), F.col("name").alias("b")
        ),
        tables["gpoint"].select(
            F.lit("gpoint").alias("table_name"), F.col("gentity_ptr_id").alias("id"), F.col("srid").alias("a"),
            F.col("abscissa").cast("string").alias("b"),
        ),
        tables["station"].select(
            F.lit("station").alias("table_name"), F.col("gpoint_ptr_id").alias("id"), F.col("type_id").alias("a"),
            F.col("is_active").cast("string").alias("b"),
        ),
    )


@query("""
    WITH st AS (SELECT * FROM (VALUES (1, 10, 0), (2, 60, 0), (3, 1440, 0), (4, 0, 1), (5, 0, 12)) v(id, m, n))
    SELECT t.event_id AS id, t.user_id AS gentity_id, st.id AS time_step_id, CASE WHEN event_type = 'view' THEN 0 END AS nominal_offset_minutes,
           CASE WHEN st.n > 0 THEN -60 ELSE 0 END AS actual_offset_minutes, st.n AS actual_offset_months
    FROM (SELECT *, CASE event_type WHEN 'click' THEN 2 ELSE 1 END AS unit,
                 CASE event_type WHEN 'view' THEN 10 WHEN 'click' THEN CASE WHEN value > 20 THEN 1 ELSE 12 END WHEN 'error' THEN 60 ELSE 30 END AS len
          FROM events) t
    LEFT JOIN st ON (unit = 1 AND st.m = len AND st.n = 0) OR (unit = 2 AND st.m = 0 AND st.n = len)
""")
def weather_series(spark, folder):
    kind = F.col("event_type")
    length = F.when(kind == "view", 10).when(kind == "click", F.when(F.col("value") > 20, 1).otherwise(12)).when(kind == "error", 60).otherwise(30)
    none = F.lit(None).cast("string")
    series = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("gentity"), F.lit(1).alias("var"), F.lit(1).alias("munit"),
        F.lit(2).alias("precision"), kind.alias("name_en"), none.alias("remarks_en"), F.lit(1).alias("instrument"),
        (kind == "view").alias("strict"), F.when(kind == "click", 2).otherwise(1).alias("tstep_unit"), length.alias("length"),
    )
    steps = spark.createDataFrame(
        values.LOCAL_TIME_STEPS, "id int, descr string, descr_alt string, length_minutes int, length_months int"
    )
    return weather.series_rows(series, steps).select(
        "id", "gentity_id", "time_step_id", "nominal_offset_minutes", "actual_offset_minutes", "actual_offset_months"
    )


@query(f"""
    WITH links AS (
        SELECT o_orderkey AS entity_id, c_custkey AS asset_id, c_nationkey AS source_id
        FROM orders JOIN customer ON o_custkey = c_custkey),
    e AS (SELECT o_orderkey AS id, o_orderpriority AS old_name FROM orders)
    SELECT e.id, CASE WHEN n.n_nationkey IS NULL THEN e.old_name ELSE left(n.n_name, 200) END AS name,
           CASE WHEN n.n_nationkey IS NULL THEN 'old' WHEN n.n_regionkey < 4
                THEN chr(10) || 'Τοποθεσία: ' || n.n_name || chr(10) || 'Δήμος: ' || n.n_nationkey ELSE '' END AS remarks,
           CASE WHEN n.n_regionkey < 4 THEN {_PREFECTURE.replace('CASE prefecture', 'CASE n.n_nationkey')} END AS political_division_id,
           CASE WHEN n.n_nationkey IS NULL THEN 5
                WHEN n.n_regionkey < 4 AND n.n_regionkey > 1 THEN n.n_regionkey + 1000 END AS water_basin_id
    FROM e LEFT JOIN links l ON l.entity_id = e.id LEFT JOIN nation n ON n.n_nationkey = l.source_id AND n.n_regionkey > 0
""")
def asset_entities(spark, folder):
    from stationflow.operators.joins import link_assets

    orders, customer, nation = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    none, no_id = F.lit(None).cast("string"), F.lit(None).cast("int")
    known = nation.where(F.col("n_regionkey") > 0)
    key = F.col("n_nationkey").alias("id")
    real = known.where(F.col("n_regionkey") < 4)
    name, code = F.col("n_name"), F.col("n_nationkey").cast("string")
    source = {
        "gentities": known.select(
            key, "n_name", none.alias("descr"), none.alias("remarks"), none.alias("name_en"), none.alias("descr_en"), none.alias("remarks_en")
        ).withColumnRenamed("n_name", "name"),
        "gentities_real": real.select(
            key, F.col("n_nationkey").alias("prefecture"), name.alias("location"), name.alias("location_en"),
            code.alias("municipality"), code.alias("municipality_en"),
        ),
        "gpoints": known.where(F.col("n_regionkey") > 1).select(key, F.col("n_regionkey").alias("basin")),
    }
    entities = orders.select(
        F.col("o_orderkey").alias("id"), F.lit(5).alias("water_basin_id"), no_id.alias("water_division_id"),
        no_id.alias("political_division_id"), F.col("o_orderpriority").alias("name"), F.lit("").alias("short_name"),
        F.lit("old").alias("remarks"), F.lit("").alias("name_alt"), F.lit("").alias("short_name_alt"), F.lit("").alias("remarks_alt"),
    )
    rows = orders.select(F.col("o_orderkey").alias("gpoint_ptr_id"), F.col("o_custkey").alias("gisentity_ptr_id"))
    registry = customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("gis_id"))
    links = link_assets(rows, registry, "gpoint_ptr_id", "gis_id")
    return assets.completed_entities(entities, links, source).select(
        "id", "name", "remarks", "political_division_id", "water_basin_id"
    )


@query("""
    SELECT p_partkey AS id, p_size > 25 AS closed, CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END AS dimensions,
           CASE WHEN p_brand = 'Brand#1' THEN '' ELSE 'gentityfile/imported_xsection_' || p_partkey || '.png' END AS drawing_file,
           p_size AS xsection_type_id
    FROM part
""")
def cross_section_rows(spark, folder):
    sections = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 25, True).alias("closed"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("dimensions"), F.col("p_size").alias("xsection_type"),
        F.when(F.col("p_brand") != "Brand#1", F.col("p_name").cast("binary")).alias("drawing"),
    )
    return assets.cross_sections(sections)


@query("""
    WITH t AS (
        SELECT o_orderkey AS old_id, c_custkey + 1000000 AS gentity_id, o_orderpriority AS name, o_orderstatus AS bottom,
               5000 + row_number() OVER (ORDER BY o_orderkey) AS id
        FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE c_nationkey < 20 AND o_totalprice <= 300000 AND o_orderstatus <> 'P')
    SELECT t.id, t.old_id, t.gentity_id, t.name, FALSE AS hidden,
           chr(10) || 'Type: ' || CASE WHEN t.bottom = 'F' THEN 'Raw data' ELSE 'Processed data' END AS remarks_alt, r.top, r.chunks
    FROM t JOIN (SELECT l_orderkey, '' AS top, count(*) AS chunks FROM lineitem GROUP BY l_orderkey) r ON r.l_orderkey = t.old_id
""")
def asset_series(spark, folder):
    from stationflow.operators.joins import link_assets
    from stationflow.plans.common import Target

    orders, customer, lineitem = (table(spark, folder, t) for t in ("orders", "customer", "lineitem"))
    none, number = F.lit(None).cast("string"), F.lit(None).cast("int")
    registry = customer.select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") < 20, 2).otherwise(3).alias("gtype_id"), F.col("c_custkey").alias("gis_id")
    )
    pumps = customer.select((F.col("c_custkey") + 1000000).alias("gpoint_ptr_id"), F.col("c_custkey").alias("gisentity_ptr_id"))
    status = F.col("o_orderstatus")
    source = {
        "timeseries": orders.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("gentity"), F.lit(1).alias("var"), number.alias("unit"),
            F.col("o_orderpriority").alias("name"), none.alias("name_en"), F.lit(2).alias("precision"), none.alias("remarks"),
            none.alias("remarks_en"), F.when(status == "F", 1).when(status == "O", 2).otherwise(3).alias("ttype"),
            number.alias("instrument"), F.lit(1).alias("tstep"), F.lit(2).alias("var_type"), F.lit(True).alias("tstep_strict"),
            F.lit(True).alias("hydrological_year"), number.alias("toffset"), (F.col("o_totalprice") > 300000).alias("synth"),
        ),
        "ts_records": lineitem.select(
            F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("num"), none.alias("top"),
            F.lit(None).cast("binary").alias("middle"), F.col("l_returnflag").alias("bottom"),
        ),
    }
    existing = {"timeseries": spark.createDataFrame([(5000,)], "id bigint")}
    target = Target(existing)
    assets.add_series(target, source, link_assets(pumps, registry, "gpoint_ptr_id", "gis_id", kind=2))
    chunks = target["ts_records"].groupBy(F.col("id").alias("_id"), "top").agg(F.count("*").alias("chunks"))
    series = target["timeseries"].where(F.col("old_id").isNotNull())
    return series.join(chunks, F.col("id") == F.col("_id")).select(
        "id", "old_id", "gentity_id", "name", "hidden", "remarks_alt", "top", "chunks"
    )
