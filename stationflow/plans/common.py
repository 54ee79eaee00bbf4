"""Rows that several plans build alike."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.functions.decode import (
    actual_offset_months,
    interval_type,
    nominal_offset_minutes,
    nominal_offset_months,
    prefecture_division,
    series_kind,
    time_step,
)
from stationflow.functions.keys import or_default
from stationflow.functions.text import append_remark, extension, media_path, truncated
from stationflow.operators.ids import assign_ids, next_id, next_ids
from stationflow.operators.quality import fk_report
from stationflow.operators.skew import one_per_key
from stationflow.operators.tables import append, project, stack
from stationflow.operators.updates import new
from stationflow.sinks.store import Load, Store

# The references between target tables as (table, column, table, column).
REFERENCES = (
    ("garea", "gentity_ptr_id", "gentity", "id"),
    ("gpoint", "gentity_ptr_id", "gentity", "id"),
    ("politicaldivision", "garea_ptr_id", "garea", "gentity_ptr_id"),
    ("politicaldivision", "parent_id", "politicaldivision", "garea_ptr_id"),
    ("waterdivision", "garea_ptr_id", "garea", "gentity_ptr_id"),
    ("waterbasin", "garea_ptr_id", "garea", "gentity_ptr_id"),
    ("waterbasin", "parent_id", "waterbasin", "garea_ptr_id"),
    ("waterbasin", "water_division_id", "waterdivision", "garea_ptr_id"),
    ("gentityaltcode", "gentity_id", "gentity", "id"),
    ("gentityaltcode", "type_id", "gentityaltcodetype", "id"),
    ("gentityevent", "gentity_id", "gentity", "id"),
    ("gentityfile", "gentity_id", "gentity", "id"),
    ("gentitygenericdata", "gentity_id", "gentity", "id"),
    ("station", "gpoint_ptr_id", "gpoint", "gentity_ptr_id"),
    ("station", "type_id", "stationtype", "id"),
    ("instrument", "station_id", "station", "gpoint_ptr_id"),
    ("instrument", "type_id", "instrumenttype", "id"),
    ("overseer", "station_id", "station", "gpoint_ptr_id"),
    ("overseer", "person_id", "person", "lentity_ptr_id"),
    ("person", "lentity_ptr_id", "lentity", "id"),
    ("organization", "lentity_ptr_id", "lentity", "id"),
    ("timeseries", "gentity_id", "gentity", "id"),
    ("timeseries", "instrument_id", "instrument", "id"),
    ("timeseries", "variable_id", "variable", "id"),
    ("timeseries", "time_step_id", "timestep", "id"),
    ("timeseries", "time_zone_id", "timezone", "id"),
    ("timeseries", "unit_of_measurement_id", "unitofmeasurement", "id"),
    ("ts_records", "id", "timeseries", "id"),
)

Tables = dict[str, DataFrame]
Source = Mapping[str, DataFrame]


# The columns of the source's detail rows.
DETAILS = ("prefecture", "location", "location_en", "municipality", "municipality_en")


class Target:
    """The target tables while a plan adds to them.

    ``existing`` may be a load of a store: then new ids come from its sequences, and
    no table is searched for its greatest id.
    """

    def __init__(self, existing: Source | None = None):
        self.load = existing if isinstance(existing, Load) else None
        self.tables: Tables = dict(existing or {})

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def __setitem__(self, name: str, table: DataFrame) -> None:
        self.tables[name] = table

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def add(
        self, name: str, rows: DataFrame, serial: Sequence[str] | None = None, unique: bool = False, helpers: Sequence[str] = ()
    ) -> DataFrame:
        """Append rows, numbering them after the table's ids when ``serial`` gives their order.

        ``helpers`` are columns that only serve the numbering.
        """
        table = self.tables.get(name)
        if serial is not None:
            rows = self.number(name, rows, serial, unique=unique).drop(*helpers)
        elif self.load is not None and "id" in rows.columns:
            self.load.observe(name, rows)
        if table is not None:
            # Later inserts may name columns that earlier ones left to their default.
            types = dict(rows.dtypes)
            missing = [c for c in rows.columns if c not in table.columns]
            table = table.withColumns({c: F.lit(None).cast(types[c]) for c in missing})
        self.tables[name] = append(table, rows)
        return rows

    def number(self, name: str, rows: DataFrame, order: Sequence[str], key: str = "id", unique: bool = False) -> DataFrame:
        """The rows with the next ids of a table, in the given order."""
        if self.load is not None:
            return self.load.number(name, rows, order, key, unique)
        start = next_id(self.tables[name]) if name in self.tables else 1
        return assign_ids(rows, order, start, key, unique)

    def next_ids(self, names: Iterable[str]) -> DataFrame:
        """The next id of each table that has ids."""
        return next_ids({n: self.tables[n] for n in names if n in self.tables and "id" in self.tables[n].columns})


def run_into(spark: SparkSession, folder: str, plan: Callable[[Load], Tables], dry_run: bool = False) -> dict[str, int]:
    """Run a plan on a store's tables and make all that it gives the store's state, at once.

    ``plan`` takes the load in place of the existing tables. A reference without a row
    discards the load and is an error; a dry run discards it in any case and returns
    the violations by reference.
    """
    with Store(spark, folder).begin() as load:
        for name, table in plan(load).items():
            if name not in load or not table.sameSemantics(load[name]):
                load.put(name, table)
        return load.commit(violations, dry_run)


def violations(tables: Source) -> DataFrame:
    """``(reference, violations)`` for every reference between tables that a plan has made."""
    checks = [
        (f"{child}.{key}", tables[child], key, tables[parent], parent_key)
        for child, key, parent, parent_key in REFERENCES
        if child in tables and parent in tables and key in tables[child].columns and parent_key in tables[parent].columns
    ]
    return fk_report(checks)


def entity(**columns: Column | str) -> dict[str, Column | str]:
    """A ``gentity`` row; text that is not given is ''."""
    texts = ("name", "short_name", "remarks", "name_alt", "short_name_alt", "remarks_alt")
    return {**columns, **{t: columns.get(t, F.lit("")) for t in texts}}


def lookup(df: DataFrame, key: str, descr: str) -> DataFrame:
    """``(id, descr, '')`` of a lookup table in one language."""
    return project(df, {"id": key, "descr": descr, "descr_alt": F.lit("")})


def entity_texts() -> dict[str, Column]:
    """Names and remarks of a bilingual source entity, bounded and without NULLs."""
    return {
        "name": or_default(truncated("name", values.NAME_LENGTH), ""),
        "short_name": or_default(truncated("descr", values.SHORT_NAME_LENGTH), ""),
        "remarks": or_default("remarks", ""),
        "name_alt": or_default("name_en", ""),
        "short_name_alt": or_default("descr_en", ""),
        "remarks_alt": or_default("remarks_en", ""),
    }


def gathered(key: str, **tables: DataFrame) -> DataFrame:
    """One row per key with a struct per table, NULL where the table has no row.

    The tables are stacked and grouped once, instead of being joined one by one.
    """
    pieces = [
        t.select(key, F.struct(*[c for c in t.columns if c != key]).alias(name)) for name, t in tables.items()
    ]
    return one_per_key(stack(*pieces), [key], *[F.min(name).alias(name) for name in tables])


def if_present(part: str, value: Column, otherwise: Column | str) -> Column:
    """The value when the gathered source row has this part."""
    return F.when(new(part).isNotNull(), value).otherwise(F.col(otherwise) if isinstance(otherwise, str) else otherwise)


def detail_remarks(remark: Column | str, language: int) -> Column:
    """Location and municipality of the gathered ``detail`` appended to a remark."""
    suffix = ("", "_en")[language]
    located = append_remark(remark, values.LOCATION_LABELS[language], new(f"detail.location{suffix}"))
    return append_remark(located, values.MUNICIPALITY_LABELS[language], new(f"detail.municipality{suffix}"))


def detail_division() -> Column:
    """The gathered ``detail``'s prefecture as a division; NULL when unmapped."""
    return prefecture_division(new("detail.prefecture"))


def file_columns(media_name: str) -> dict[str, Column | str]:
    """The columns of a file row except its entity."""
    return {
        "descr": or_default("multimedia_name", ""),
        "descr_alt": or_default("multimedia_name_en", ""),
        "remarks": or_default("remarks", ""),
        "remarks_alt": or_default("remarks_en", ""),
        "date": "mdate",
        "file_type_id": "ftype",
        "content": media_path(f"gentityfile/{media_name}", "id", "num", extension("ftype")),
    }


def curve_columns(data_type: int) -> dict[str, Column | str | int]:
    """The columns of a curve's still empty document, except its entity."""
    return {
        "id": "id",
        "descr": or_default("name", ""),
        "descr_alt": or_default("name_en", ""),
        "remarks": or_default("remarks", ""),
        "remarks_alt": or_default("remarks_en", ""),
        "data_type_id": data_type,
        "content": F.lit(""),
    }


def loadable_series(series: DataFrame) -> DataFrame:
    """Raw and processed series that are not synthetic."""
    return series.where((F.col("synth") == False) & (F.col("ttype") < 3))  # noqa: E712


def series_columns() -> dict[str, Column | str | int]:
    """The metadata columns of a series, except its keys."""
    main, alternate = values.KIND_LABELS
    return {
        "variable_id": "var",
        "unit_of_measurement_id": or_default("unit", values.UNIT_NOT_SET[0]),
        "name": or_default("name", ""),
        "name_alt": or_default("name_en", ""),
        "precision": "precision",
        "time_zone_id": 1,
        "remarks": append_remark(or_default("remarks", ""), main, series_kind("ttype")),
        "remarks_alt": append_remark(or_default("remarks_en", ""), alternate, series_kind("ttype", alternate=True)),
        "instrument_id": "instrument",
        "time_step_id": time_step("tstep"),
        "interval_type_id": interval_type("var_type"),
        "nominal_offset_minutes": nominal_offset_minutes("tstep_strict"),
        "nominal_offset_months": nominal_offset_months("tstep_strict", "hydrological_year"),
        "actual_offset_minutes": or_default("toffset", 0),
        "actual_offset_months": actual_offset_months("tstep"),
    }
