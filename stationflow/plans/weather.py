"""The local weather network: countries, stations, instruments and series of one installation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.functions.decode import decode_members, nominal_offset_minutes
from stationflow.operators.joins import left_with_fixed, match_time_steps
from stationflow.operators.series import shifted_series
from stationflow.operators.tables import literal_table, project, split_entity
from stationflow.plans.common import Source, Tables, Target, entity, lookup
from stationflow.plans.national import NUMBERED, unit_variables

# Id offset of the countries, and the country of all stations.
COUNTRIES = 100
COUNTRY = 187
SRID = 2100
MONTHLY_OFFSET_MINUTES = -60


def series_rows(series: DataFrame, steps: DataFrame) -> DataFrame:
    """Series metadata with the time step found by unit and length."""
    matched = match_time_steps(series, "tstep_unit", "length", steps)
    strict = nominal_offset_minutes("strict")
    return project(matched, {
        "id": "id", "gentity_id": "gentity", "variable_id": "var", "unit_of_measurement_id": "munit",
        "precision": "precision", "name": "name_en", "time_zone_id": 1, "remarks": "remarks_en",
        "instrument_id": "instrument", "time_step_id": "time_step_id",
        "nominal_offset_minutes": strict, "nominal_offset_months": strict,
        "actual_offset_minutes": F.when(F.col("length_months") > 0, MONTHLY_OFFSET_MINUTES).otherwise(0),
        "actual_offset_months": "length_months",
    })


def load(spark: SparkSession, source: Source, existing: Source | None = None) -> Tables:
    target = Target(existing)
    no_text, no_id = F.lit(""), F.lit(None).cast("int")
    country = F.col("descr") + COUNTRIES
    people_texts = ("middle_names", "initials", "last_name_alt", "first_name_alt", "middle_names_alt", "initials_alt")
    named = left_with_fixed(
        source["vstations"], "name", source["string_contents"], "id", "string", {"language": "gr"}, "local_name"
    )
    pieces = [
        split_entity(source["vcountries"], {
            "gentity": entity(id=country, name="descr_en", short_name="descr_en"),
            "garea": {"gentity_ptr_id": country},
            "politicaldivision": {"garea_ptr_id": country, "parent_id": no_id, "code": F.lower("code")},
        }),
        split_entity(source["vpeople"], {
            "lentity": {"id": "id", "remarks": no_text, "remarks_alt": no_text},
            "person": {
                "lentity_ptr_id": "id", "last_name": "last_name_en", "first_name": "first_names_en",
                **{t: no_text for t in people_texts},
            },
        }),
        {"stationtype": lookup(source["vstypes"], "id", "descr_en")},
        {"gentity": project(named, entity(
            id="id", water_basin_id=no_id, water_division_id=no_id, political_division_id=F.lit(COUNTRY),
            name="local_name", short_name="local_name", remarks="address_en", name_alt="name_en", short_name_alt="name_en",
        ))},
        split_entity(source["vstations"], {
            "gpoint": {
                "gentity_ptr_id": "id", "abscissa": "x", "ordinate": "y", "srid": SRID, "approximate": False,
                "altitude": "altitude", "asrid": no_id,
            },
            "station": {
                "gpoint_ptr_id": "id", "owner_id": "owner", "type_id": "stype", "is_active": "station_active",
                "is_automatic": "telemetry", "start_date": F.lit(None).cast("date"), "end_date": F.lit(None).cast("date"),
            },
        }),
        {
            "instrumenttype": literal_table(
                spark, [(i, descr, "") for i, descr in values.INSTRUMENT_TYPES], "id int, descr string, descr_alt string"
            ),
            "instrument": project(source["vinstruments"], {
                "id": "id", "station_id": "station",
                "type_id": decode_members("id", values.INSTRUMENT_TYPE_MEMBERS),
                "manufacturer": no_text, "model": no_text, "is_active": "instrument_active",
                "start_date": F.lit(None).cast("date"), "end_date": F.lit(None).cast("date"),
                "name": "name_en", "remarks": no_text, "name_alt": no_text, "remarks_alt": no_text,
            }),
            "unitofmeasurement": project(
                source["vmunits"], {"id": "id", "symbol": "symbol", "descr": "name_en", "descr_alt": no_text}
            ),
            "variable": lookup(source["vvars"], "id", "descr_en"),
            "unitofmeasurement_variables": unit_variables(spark, values.LOCAL_UNIT_VARIABLES),
            "timezone": literal_table(spark, values.TIME_ZONES, "id int, code string, utc_offset int"),
            "timestep": literal_table(
                spark, values.LOCAL_TIME_STEPS,
                "id int, descr string, descr_alt string, length_minutes int, length_months int",
            ),
        },
    ]
    for piece in pieces:
        for table, rows in piece.items():
            target.add(table, rows)
    target.add("timeseries", series_rows(source["vtimeseries"], target["timestep"]))
    chunks = source["timeseries_records"]
    target.add("ts_records", chunks.select("id", F.coalesce("top", F.lit("")).alias("top"), "middle", "bottom"))
    target["next_ids"] = target.next_ids(NUMBERED)
    return target.tables


def shift_monthly(records: DataFrame, series: DataFrame) -> DataFrame:
    """The monthly and annual series' records, moved one hour to the start of a month."""
    return shifted_series(records, series)
