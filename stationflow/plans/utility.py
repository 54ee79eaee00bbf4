"""The water utility's network: stations, basins, events, files, curves and series."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.functions.keys import first_present, offset_key, or_default
from stationflow.functions.text import append_remark, extension, media_path
from stationflow.operators.documents import stage_discharge_documents, write_documents
from stationflow.operators.joins import carry_records, members
from stationflow.operators.series import with_phases
from stationflow.operators.tables import (
    copy_lookup,
    literal_table,
    project,
    split_entity,
    unpivot_codes,
)
from stationflow.operators.updates import new, update_from
from stationflow.plans.common import (
    DETAILS,
    Source,
    Tables,
    Target,
    curve_columns,
    detail_division,
    detail_remarks,
    entity_texts,
    file_columns,
    gathered,
    if_present,
    loadable_series,
    series_columns,
)
from stationflow.sinks.files import Written, write_blobs

# Id offsets and the datum of the points.
ENTITIES, WATER_DISTRICTS, SRID = 1000, 500, 2100
# The code type of the basins and the document type of the curves.
BASIN_CODE_TYPE, CURVE_TYPE = 2, 1
# Tables whose next id is reported.
NUMBERED = (
    "gentity", "lentity", "stationtype", "eventtype", "gentityevent", "gentityaltcode", "gentityaltcodetype",
    "gentityfile", "filetype", "instrumenttype", "instrument", "variable", "timezone", "unitofmeasurement",
    "timestep", "timeseries", "gentitygenericdata",
)
# Source lookup -> target lookup.
LOOKUPS = {"stypes": "stationtype", "gevent_types": "eventtype", "itypes": "instrumenttype", "vars": "variable"}


def organization_tables(services: DataFrame) -> Tables:
    return split_entity(services, {
        "lentity": {"id": "id", "remarks": F.lit(""), "remarks_alt": F.lit("")},
        "organization": {
            "lentity_ptr_id": "id", "name": or_default("descr", ""), "acronym": or_default("short_descr", ""),
            "name_alt": or_default("descr_en", ""), "acronym_alt": or_default("short_descr_en", ""),
        },
    })


def entity_rows(entities: DataFrame) -> DataFrame:
    """Stations and basins as entities; their divisions are set later."""
    chosen = entities.where(F.col("terminal_subtable").isin("stations", "basins"))
    no_id = F.lit(None).cast("int")
    return project(chosen, {
        "id": offset_key("id", ENTITIES), "water_basin_id": no_id, "water_division_id": no_id,
        "political_division_id": no_id, **entity_texts(),
    })


def completed_entities(entities: DataFrame, source: Source) -> DataFrame:
    """Divisions, basins and remarks taken from the tables around the entity.

    The tables keyed by the entity's id are gathered and update it in one join;
    the water division follows from the basin found there.
    """
    def shifted(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(offset_key("id", ENTITIES).alias("_entity"), *columns)

    around = gathered(
        "_entity",
        detail=shifted(source["gentities_real"], *DETAILS),
        point=shifted(members(source["gpoints"], "id", source["gentities"], "id"), "basin"),
        station=shifted(source["stations"], "observer", "observer_en"),
    )
    sets = {
        "political_division_id": if_present("detail", detail_division(), "political_division_id"),
        "water_basin_id": if_present("point", new("point.basin") + ENTITIES, "water_basin_id"),
    }
    for language, (column, observer) in enumerate((("remarks", "observer"), ("remarks_alt", "observer_en"))):
        remark = if_present("detail", detail_remarks(column, language), column)
        observed = append_remark(remark, values.OBSERVER_LABELS[language], new(f"station.{observer}"))
        sets[column] = if_present("station", observed, remark)
    result = update_from(entities, around, {"id": "_entity"}, sets, unique=True)
    basins = shifted(source["basins"], "water_district")
    return update_from(
        result, basins, {"water_basin_id": "_entity"}, {"water_division_id": new("water_district") + WATER_DISTRICTS}
    )


def station_rows(stations: DataFrame) -> DataFrame:
    return project(stations, {
        "gpoint_ptr_id": offset_key("id", ENTITIES), "owner_id": "service",
        "type_id": first_present("ssubtype", "stype"), "is_active": "station_active",
        "is_automatic": "telemetry", "start_date": "start_date", "end_date": "end_date",
    })


def basin_rows(basins: DataFrame) -> DataFrame:
    """Basins with their parent and water division."""
    return project(basins, {
        "garea_ptr_id": offset_key("id", ENTITIES),
        "parent_id": offset_key("parent", ENTITIES),
        "water_division_id": offset_key("water_district", WATER_DISTRICTS),
    })


def series_rows(series: DataFrame, entities: DataFrame) -> DataFrame:
    """Metadata of the series whose entity is loaded."""
    shifted = loadable_series(series).withColumn("gentity", offset_key("gentity", ENTITIES))
    loaded = members(shifted, "gentity", entities, "id")
    return project(loaded, {"id": "id", "gentity_id": "gentity", **series_columns()})


def add_events_and_files(target: Target, source: Source, media_name: str) -> None:
    """Events, file types and the file rows of the entities that are loaded."""
    target.add("gentityevent", project(source["gentities_events"], {
        "gentity_id": offset_key("id", ENTITIES), "date": "event_date", "type_id": "event_type",
        "user": or_default("event_user", ""), "report": or_default("report", ""), "report_alt": or_default("report_en", ""),
    }), serial=["gentity_id", "date", "type_id"])
    target.add("filetype", copy_lookup(source["ftypes"], mime_type=or_default("mime_type", "")))
    media = source["gentities_multimedia"].withColumn("gentity_id", offset_key("id", ENTITIES))
    loaded = members(media, "gentity_id", target["gentity"], "id")
    files = project(loaded, {"gentity_id": "gentity_id", "_num": "num", **file_columns(media_name)})
    target.add("gentityfile", files, serial=["gentity_id", "_num"], unique=True, helpers=["_num"])


def load(
    spark: SparkSession,
    source: Source,
    code_types: DataFrame,
    station_codes: Mapping[int, str],
    media_name: str,
    existing: Source | None = None,
) -> Tables:
    """All target tables.

    ``code_types`` is the table of alternate code types ``(id, descr, descr_alt)``
    and ``station_codes`` maps each type to the station column that holds its
    code. ``media_name`` begins the names of the extracted files. ``existing``
    holds the seeded divisions.
    """
    target = Target(existing)
    for table, rows in organization_tables(source["services"]).items():
        target.add(table, rows)
    target.add("gentityaltcodetype", code_types)
    for name, table in LOOKUPS.items():
        target.add(table, copy_lookup(source[name]))

    target.add("gentity", entity_rows(source["gentities"]))
    target["gentity"] = completed_entities(target["gentity"], source)
    points = source["gentities"].where(F.col("terminal_subtable") == "stations")
    target.add("gpoint", project(points, {
        "gentity_ptr_id": offset_key("id", ENTITIES), "abscissa": "x", "ordinate": "y", "srid": SRID,
        "approximate": False, "altitude": "alt", "asrid": F.lit(None).cast("int"),
    }))
    basin_entities = source["gentities"].where(F.col("terminal_subtable") == "basins")
    areas = members(source["gareas"], "id", basin_entities, "id")
    target.add("garea", project(areas, {"gentity_ptr_id": offset_key("id", ENTITIES), "area": "area"}))
    target.add("station", station_rows(source["stations"]))
    target.add("waterbasin", basin_rows(source["basins"]))
    codes = unpivot_codes(source["stations"], offset_key("id", ENTITIES), station_codes).unionByName(
        unpivot_codes(source["basins"], offset_key("id", ENTITIES), {BASIN_CODE_TYPE: "miet_code"})
    )
    target.add("gentityaltcode", codes, serial=["type_id", "gentity_id"], unique=True)

    add_events_and_files(target, source, media_name)
    curves = source["curves"].where(F.col("terminal_subtable") == "hq_curves")
    target.add("gentitygenericdata", project(curves, {
        **curve_columns(CURVE_TYPE), "gentity_id": offset_key("gentity", ENTITIES),
    }))

    target.add("instrument", project(source["instruments"], {
        "id": "id", "station_id": offset_key("station", ENTITIES), "type_id": "itype",
        **{c: or_default(s, "") for c, s in {
            "name": "name", "name_alt": "name_en", "remarks": "remarks", "remarks_alt": "remarks_en",
            "manufacturer": "manufacturer", "model": "model",
        }.items()},
        "is_active": or_default("instrument_active", False), "start_date": "start_date", "end_date": "end_date",
    }))

    target.add("timezone", literal_table(spark, values.TIME_ZONES, "id int, code string, utc_offset int"))
    target.add("unitofmeasurement", copy_lookup(source["units"], symbol=or_default("symbol", "")))
    target.add("unitofmeasurement", literal_table(
        spark, [values.UNIT_NOT_SET], "id int, descr string, descr_alt string, symbol string"
    ))
    target.add("timestep", literal_table(
        spark, values.UTILITY_TIME_STEPS, "id int, descr string, descr_alt string, length_minutes int, length_months int"
    ))
    series = target.add("timeseries", series_rows(source["timeseries"], target["gentity"]))
    target.add("ts_records", carry_records(source["ts_records"], series, first_chunk_only=True))
    target["next_ids"] = target.next_ids(NUMBERED)
    return target.tables


def fix_phases(series: DataFrame, chunks: DataFrame) -> DataFrame:
    """The series table with nominal offsets set from the first stamps."""
    return with_phases(series, chunks)


def fill_curves(documents: DataFrame, source: Source) -> DataFrame:
    """The curve table with the stage-discharge documents filled in."""
    curves = source["curves"].where(F.col("terminal_subtable") == "hq_curves")
    return write_documents(documents, stage_discharge_documents(curves, source["hq_curves"], source["hq_points"]))


def extract_files(media: DataFrame, path: str, media_name: str, mode: str = "error") -> Written:
    """Write the multimedia blobs under the names that the file rows refer to."""
    return write_blobs(media, path, media_path(media_name, "id", "num", extension("ftype")), "multimedia", mode)
