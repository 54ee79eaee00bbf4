"""The national network: numeric keys are shifted, stations of one service are loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.functions.decode import is_one
from stationflow.functions.geo import degrees_from_text
from stationflow.functions.keys import divided_key, guarded_key, in_range, or_default
from stationflow.functions.text import word
from stationflow.operators.ids import assign_ids, next_id
from stationflow.operators.joins import left_to_bridge, match_names, members
from stationflow.operators.series import (
    cloud_lines,
    merged_kinds,
    number_lines,
    text_lines,
    weather_lines,
)
from stationflow.operators.tables import literal_table, project, route_points, split_entity
from stationflow.operators.updates import get_or_create, load_once
from stationflow.plans.common import Source, Tables, Target, entity, lookup
from stationflow.sinks.files import Written, write_blobs, write_series_dir
from stationflow.sources.seriesdir import read_series_dir

# Id offsets, which let several source tables share one id space.
DISTRICTS, STATES, WATER_DISTRICTS, BASINS, SUB_BASINS = 300, 400, 500, 1000, 1400
# The country above the districts, and the one station key that does not divide.
COUNTRY = 84
STATION_DIVISOR = 10000
STATION_OVERRIDES = {5010150001: 501030}
# Tables whose next id is reported.
NUMBERED = (
    "instrumenttype", "gentity", "lentity", "stationtype", "timestep", "variable", "timezone",
    "unitofmeasurement", "timeseries", "instrument",
)


def station_key(column: Column | str) -> Column:
    return divided_key(column, STATION_DIVISOR, STATION_OVERRIDES)


def unit_variables(spark: SparkSession, pairs: dict[int, tuple[int, ...]]) -> DataFrame:
    rows = [(unit, variable) for unit, variables in pairs.items() for variable in variables]
    return literal_table(spark, rows, "unitofmeasurement_id int, variable_id int")


def _lookups(source: Source, target: Target, spark: SparkSession) -> None:
    target.add("instrumenttype", lookup(source["instruments"], "instrtype", "instrtpname"))
    target.add("stationtype", lookup(source["stcategories"].where(F.col("stcatid") > 0), "stcatid", "stcatname"))
    target.add("variable", lookup(source["variables"], "varid", "varname"))
    steps = project(
        source["timesteps"].where(F.col("minutes") > 0),
        {"id": "timeresid", "descr": "tmrname", "descr_alt": F.lit(""), "length_minutes": "minutes", "length_months": 0},
    )
    target.add("timestep", steps)
    target.add("timestep", literal_table(
        spark, values.EXTRA_TIME_STEPS, "id int, descr string, descr_alt string, length_minutes int, length_months int"
    ))
    target.add("timezone", literal_table(spark, values.TIME_ZONES, "id int, code string, utc_offset int"))
    target.add("unitofmeasurement", literal_table(
        spark, values.UNITS, "id int, symbol string, descr string, descr_alt string"
    ))
    target.add("unitofmeasurement_variables", unit_variables(spark, values.UNIT_VARIABLES))
    target.add("gentityaltcodetype", literal_table(
        spark, values.BASIN_CODE_TYPE, "id int, descr string, descr_alt string"
    ))


def add_areas(source: Source, target: Target) -> None:
    """Districts, states, water districts, basins and sub-basins."""
    def add(rows: DataFrame, key: Column, name: str, short_name: Column | str, own: str, own_columns: dict) -> None:
        pieces = split_entity(rows, {
            "gentity": entity(id=key, name=name, short_name=short_name),
            "garea": {"gentity_ptr_id": key},
            own: {"garea_ptr_id": key, **own_columns},
        })
        for table, piece in pieces.items():
            target.add(table, piece)

    no_text = F.lit("")
    districts = source["pol_districts"].where(F.col("pdid") > 0)
    add(districts, F.col("pdid") + DISTRICTS, "pdname", "pdname", "politicaldivision", {"parent_id": COUNTRY, "code": no_text})
    states = source["states"].where(F.col("pdid") > 0)
    add(states, F.col("sttid") + STATES, "sttname", "sttcodename", "politicaldivision",
        {"parent_id": F.col("pdid") + DISTRICTS, "code": no_text})
    water = source["water_districts"].where(F.col("wtrid") > 0)
    add(water, F.col("wtrid") + WATER_DISTRICTS, "wtrname", "wtrcodename", "waterdivision", {})
    basins = source["basins"].where(F.col("wbid") > 0)
    add(basins, F.col("wbid") + BASINS, "wbname", no_text, "waterbasin",
        {"water_division_id": guarded_key("wtrid", WATER_DISTRICTS), "parent_id": F.lit(None).cast("int")})

    # A sub-basin is an entity in any case, and a basin only if its parent is known.
    sub_basins = source["sub_basins"].where(F.col("wsbid") > 0)
    key = F.col("wsbid") + SUB_BASINS
    target.add("gentity", project(sub_basins, entity(id=key, name="wsbname")))
    target.add("garea", project(sub_basins, {"gentity_ptr_id": key}))
    parents = source["basins"].select(F.col("wbcode").alias("_code"), F.col("wbid").alias("_parent"))
    coded = sub_basins.where(F.col("wbcode") > 0).join(parents, F.col("wbcode") == F.col("_code"))
    target.add("waterbasin", project(coded, {
        "garea_ptr_id": key,
        "water_division_id": F.col("wtrid") + WATER_DISTRICTS,
        "parent_id": F.col("_parent") + BASINS,
    }))
    codes = project(basins, {"gentity_id": F.col("wbid") + BASINS, "type_id": 1, "value": F.col("wbcode").cast("string")})
    codes = codes.unionByName(
        project(sub_basins, {"gentity_id": key, "type_id": 1, "value": F.col("wsbcode").cast("string")})
    )
    target.add("gentityaltcode", codes, serial=["gentity_id"], unique=True)


def series_rows(series: DataFrame, bridge: DataFrame) -> DataFrame:
    """Series metadata with each variable's units."""
    known_step = ("timeresid", 1, 7)
    none = F.lit(None).cast("int")
    joined = left_to_bridge(series, "varid", bridge, "variable_id", "unitofmeasurement_id", "unit_of_measurement_id")
    return project(joined, {
        "id": "id",
        "gentity_id": station_key("geoinfoid"),
        "variable_id": "varid",
        "unit_of_measurement_id": "unit_of_measurement_id",
        "precision": none,
        "name": F.lit(""),
        "time_zone_id": 1,
        "remarks": or_default("comments", ""),
        "instrument_id": divided_key("instrid", 100),
        "time_step_id": in_range(*known_step),
        "nominal_offset_minutes": none,
        "nominal_offset_months": none,
        "actual_offset_minutes": in_range(*known_step, F.lit(0)),
        "actual_offset_months": in_range(*known_step, F.lit(0)),
    })


def station_tables(stations: DataFrame) -> Tables:
    """The stations of one service as entity, point and station rows."""
    key = station_key("stationid")
    routed = route_points(
        stations, "x", "y", "phi", "lamda",
        lambda lat, lon: (degrees_from_text(lat), degrees_from_text(lon, trimmed=True)),
    )
    return split_entity(routed, {
        "gentity": entity(
            id=key,
            water_basin_id=guarded_key("wbid", BASINS),
            water_division_id=guarded_key("wtrid", WATER_DISTRICTS),
            political_division_id=guarded_key("sttid", STATES),
            name=or_default("stationname", "Anonymous"),
            remarks=or_default("comments", ""),
        ),
        "gpoint": {
            "gentity_ptr_id": key, "abscissa": "abscissa", "ordinate": "ordinate", "srid": "srid",
            "approximate": False, "altitude": "altitude", "asrid": F.lit(None).cast("int"),
        },
        "station": {
            "gpoint_ptr_id": key, "owner_id": "srvid", "type_id": guarded_key("stcatid", default=1),
            "is_active": is_one("st_isactiv"), "is_automatic": False,
            "start_date": "startdate", "end_date": "enddate",
        },
    })


def instrument_rows(configured: DataFrame, stations: DataFrame) -> DataFrame:
    """The instruments of these stations."""
    instruments = members(configured, "stationid", stations, "stationid")
    return project(instruments, {
        "id": divided_key("stconfigid", 100), "station_id": station_key("stationid"), "type_id": "instrtype",
        "manufacturer": F.lit(""), "model": F.lit(""), "is_active": False,
        "start_date": "instartdate", "end_date": "inenddate", "name": F.lit(""),
        "remarks": or_default("notes", ""), "name_alt": F.lit(""), "remarks_alt": F.lit(""),
    })


def add_people(stations: DataFrame, target: Target, one_per_name: bool = True) -> None:
    """Persons, their legal entities and overseers from the stations' observers."""
    observed = stations.where(F.col("observer") != "")
    named = observed.select("stationid", word("observer", 1).alias("last_name"), word("observer", 2).alias("first_name"))
    if one_per_name:
        named = named.groupBy("last_name", "first_name").agg(F.min("stationid").alias("stationid"))
    people = target.number("lentity", named, ["stationid"], key="lentity_ptr_id", unique=True)
    texts = ("middle_names", "initials", "last_name_alt", "first_name_alt", "middle_names_alt", "initials_alt")
    person = project(people, {
        "lentity_ptr_id": "lentity_ptr_id", "last_name": "last_name", "first_name": "first_name",
        **{t: F.lit("") for t in texts},
    })
    target.add("person", person)
    target.add("lentity", project(person, {"id": "lentity_ptr_id", "remarks": F.lit(""), "remarks_alt": F.lit("")}))
    overseers = match_names(stations, "observer", target["person"], "last_name", "first_name", key="lentity_ptr_id")
    target.add("overseer", project(overseers, {
        "station_id": station_key("stationid"), "person_id": "person_id", "is_current": False,
    }))


def load(
    spark: SparkSession, source: Source, service_id: int, existing: Source | None = None, one_person_per_name: bool = True
) -> Tables:
    """All target tables, with the stations and instruments of one service.

    Every observer's name gives one person. With ``one_person_per_name=False``
    every station with an observer gives a person of its own, and an overseer row
    for every person of the same name: the square of a name's stations.
    """
    target = Target(existing)
    _lookups(source, target, spark)
    add_areas(source, target)
    services = split_entity(source["services"], {
        "lentity": {"id": "srvid", "remarks": F.lit(""), "remarks_alt": F.lit("")},
        "organization": {
            "lentity_ptr_id": "srvid", "name": "srvname", "acronym": "srvcodename",
            "name_alt": F.lit(""), "acronym_alt": F.lit(""),
        },
    })
    for table, rows in services.items():
        target.add(table, rows)
    target.add("timeseries", series_rows(source["raw_timeseries_info"], target["unitofmeasurement_variables"]))
    stations = source["stations"].where(F.col("srvid") == service_id)
    target.add("instrument", instrument_rows(source["stationconfig"], stations))
    for table, rows in station_tables(stations).items():
        target.add(table, rows)
    add_people(stations, target, one_person_per_name)
    target["next_ids"] = target.next_ids(NUMBERED)
    return target.tables


def export_records(source: Source, out: str, mode: str = "error") -> dict[str, Written]:
    """Write the record tables as one text file per series.

    A series found in both record tables keeps its text records.
    """
    both = merged_kinds(
        number_lines(source["raw_timeseries_float_data"]), text_lines(source["raw_timeseries_string_data"])
    )
    folders = {
        "timeseries": both,
        "cloud_observations": cloud_lines(source["cloud_observation"]),
        "weather_observations": weather_lines(source["weather_observation"]),
    }
    return {name: write_series_dir(lines, f"{out.rstrip('/')}/{name}", mode) for name, lines in folders.items()}


def load_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of a folder of series files."""
    return read_series_dir(spark, folder)


def load_images(
    images: DataFrame, target_files: DataFrame, file_types: DataFrame, mime_type: str = "image/jpeg"
) -> tuple[DataFrame, DataFrame]:
    """Station images as ``(file rows with their bytes, file types)``.

    Gives no rows when the target has files already. The file type is added
    when it is missing.
    """
    spark = images.sparkSession
    wanted = literal_table(spark, [(mime_type,)], "mime_type string")
    wanted = wanted.withColumn("id", next_id(file_types).cast("int"))
    types = get_or_create(file_types, "mime_type", wanted)
    type_id = types.where(F.col("mime_type") == mime_type).agg(F.min("id").alias("id")).scalar()
    rows = load_once(target_files, images).select(
        station_key("stationid").alias("gentity_id"), F.col("stimgdate").alias("date"), F.col("stimgdata").alias("bytes")
    )
    numbered = assign_ids(rows, ["gentity_id", "date"])
    return (
        numbered.withColumns({
            "file_type_id": type_id,
            "content": F.format_string("%d-%d.jpg", "gentity_id", "id"),
        }),
        types,
    )


def write_images(files: DataFrame, path: str, mode: str = "error") -> Written:
    """One image file per row of ``load_images``."""
    return write_blobs(files, path, F.col("content"), "bytes", mode)
