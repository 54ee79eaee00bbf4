"""The utility's water-supply assets: one plan, seven kinds of asset."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.functions.keys import or_default
from stationflow.functions.text import drawing_path
from stationflow.operators.documents import curve_documents, write_documents
from stationflow.operators.joins import carry_records, link_assets
from stationflow.operators.tables import copy_lookup, literal_table, project, with_old_id
from stationflow.operators.updates import (
    insert_missing,
    missing_keys,
    new,
    update_from,
    update_where_in,
)
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

# Offset of the basin ids; beginning of the drawings' file names.
BASINS = 1000
DRAWING_NAME = "imported_xsection_"
DRAWING_EXTENSION = "png"

# Curve subtype -> (document type, order column, number columns, point table).
CURVES = {
    "reservoir_hsvb": (2, "h", ("h", "s", "v"), "reservoir_hsvb"),
    "reservoir_leakage": (3, "month", ("value_a", "value_b", "value_c", "value_e"), "reservoir_leakage"),
    "reservoir_spill": (4, "h", ("h", "q"), "reservoir_spill"),
    "duct_discharge_capacity": (5, "head", ("head", "discharge"), "duct_discharge_capacity"),
}


def _same(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def _renamed(**names: str) -> dict[str, Column]:
    return {target: F.col(source) for target, source in names.items()}


def _node_source(source: Source) -> DataFrame:
    return source["aqueducts"].join(source["conduits"], "id")


def _segment_source(source: Source) -> DataFrame:
    lines = source["glines"].select("id", "alt2")
    heights = source["gentities"].select("id", F.col("alt").alias("alt1"))
    return _node_source(source).join(lines, "id").join(heights, "id")


def _aqueduct_fields() -> dict[str, Column]:
    return {
        "measure_discharge": or_default("measure_discharge", False),
        "measure_stage": or_default("measure_stage", False),
        "repers": or_default("repers", ""),
        "repers_en": or_default("repers_en", ""),
        **_same("start_position", "end_position"),
        **_renamed(group_id="parent", duct_segment_type_id="duct_segment_type", duct_status_id="duct_status"),
    }


@dataclass(frozen=True)
class Asset:
    """What distinguishes one kind of asset from the others."""

    kind: int
    table: str
    link: str
    pointer: str
    details: Callable[[Source], DataFrame]
    fields: Mapping[str, Column] = field(default_factory=dict)
    lookups: Mapping[str, str] = field(default_factory=dict)
    altitude: bool = False
    length: bool = False
    shared: bool = False
    curves: tuple[str, ...] = ()
    curve_types: tuple[tuple, ...] = ()


def assets() -> dict[str, Asset]:
    """The seven kinds. Springs come before boreholes and nodes before segments (shared lookups)."""
    return {
        "springs": Asset(
            4, "gisspring", "original_gentity_id", "gisboreholespring_ptr_id",
            lambda s: s["springs"],
            {**_renamed(dstype_id="dstype", hgeo_info_id="hgeo_info"), "is_continuous": or_default("is_continuous", False)},
            {
                "gisboreholespringwateruse": "water_uses", "gisboreholespringwateruser": "water_users",
                "gisboreholespringlanduse": "land_uses", "gisspringdstype": "dstypes", "gisspringhgeoinfo": "hgeo_infos",
            },
            shared=True,
        ),
        "boreholes": Asset(
            1, "gisborehole", "gis_id", "gisboreholespring_ptr_id",
            lambda s: s["boreholes"],
            {
                "has_pmeter": or_default("has_pmeter", False),
                **_renamed(pmeter_type_id="pmeter_type", drill_type_id="drill_type", pipe_mat_id="pipe_mat"),
                **_same(
                    "pmeter_length", "pmeter_diameter", "borehole_depth", "pipe_depth", "water_depth",
                    "value_t", "value_s", "value_b", "value_k", "threshold_a", "threshold_b",
                    "continuous_stage", "test_flow", "test_stage", "begin_works", "end_works",
                    "pump_discharge", "pump_ratio",
                ),
            },
            {
                "gisboreholepmetertype": "pmeter_types", "gisboreholedrilltype": "drill_types",
                "gisboreholepipemat": "pipe_mats",
            },
            altitude=True, shared=True,
        ),
        "pumps": Asset(
            2, "gispump", "gis_id", "gpoint_ptr_id",
            lambda s: s["pumps_generators"],
            {
                **_renamed(pump_type_id="pump_type"),
                **_same(
                    "is_irrig", "is_pump", "pump_active", "is_generator", "generator_active", "pump_num",
                    "pump_discharge", "generator_num", "total_power", "generator_discharge", "pump_energy",
                    "generator_energy",
                ),
            },
            {"gispumptype": "pump_types"},
        ),
        "refineries": Asset(
            3, "gisrefinery", "gis_id", "gpoint_ptr_id",
            lambda s: s["treatment_plants"],
            _same("capacity", "peak_capacity", "storage", "overflow_stage", "outlet_level"),
            altitude=True,
        ),
        "aqueduct_nodes": Asset(
            5, "gisaqueductnode", "gis_id", "gpoint_ptr_id", _node_source, _aqueduct_fields(),
            {
                "gisductsegmenttype": "duct_segment_types", "gisductflowtype": "duct_flow_types",
                "gisductstatustype": "duct_status_types",
            },
            altitude=True,
        ),
        "aqueduct_segments": Asset(
            6, "gisaqueductline", "original_gentity_id", "gline_ptr_id", _segment_source,
            {
                **_aqueduct_fields(),
                **_renamed(
                    xsection_id="xsection", roughness_coef_type_id="roughness_coef_type",
                    duct_flow_type_id="duct_flow_type", pipe_mat_id="pipe_mat",
                ),
                **_same(
                    "area", "width", "depth", "slope", "roughness_coef", "bank_slope", "leakage_coef",
                    "discharge_capacity", "alt1", "alt2",
                ),
            },
            {"gisroughnesscoeftype": "roughness_coef_types", "gisxsectiontype": "xsection_types"},
            length=True, curves=("duct_discharge_capacity",), curve_types=tuple(values.AQUEDUCT_CURVE_TYPES),
        ),
        "reservoirs": Asset(
            7, "gisreservoir", "original_gentity_id", "garea_ptr_id",
            lambda s: s["reservoirs"],
            _same(
                "inflow_mean", "inflow_max", "inflow_min", "runoff_mean", "runoff_max", "runoff_min",
                "volume_max", "dead_volume",
            ),
            curves=("reservoir_hsvb", "reservoir_leakage", "reservoir_spill"),
            curve_types=tuple(values.RESERVOIR_CURVE_TYPES),
        ),
    }


def add_missing_boreholes(target: Target, boreholes: DataFrame) -> None:
    """Registry, borehole, point and entity rows for boreholes that have none yet."""
    known = target["gisentity"].where(F.col("gtype_id") == 1)
    unknown = missing_keys(boreholes, "id", known, "gis_id")
    registered = target.number("gisentity", unknown, ["gis_id"], unique=True)
    target.add("gisentity", project(registered, {"id": "id", "gtype_id": 1, "gis_id": "gis_id"}))

    registry = target["gisentity"].where(F.col("gtype_id") == 1)
    bare = missing_keys(registry, "id", target["gisborehole"], "gisentity_ptr_id")
    new_boreholes = target.number("gentity", bare, ["gisentity_ptr_id"], key="gisboreholespring_ptr_id", unique=True)
    target.add("gisborehole", project(new_boreholes, {
        "gisboreholespring_ptr_id": "gisboreholespring_ptr_id", "gisentity_ptr_id": "gisentity_ptr_id",
        "group": F.lit(""), "has_pmeter": False,
    }))
    target["gisboreholespring"] = insert_missing(
        target["gisborehole"], "gisboreholespring_ptr_id", target["gisboreholespring"], "gpoint_ptr_id"
    )
    target["gpoint"] = insert_missing(
        target["gisboreholespring"], "gpoint_ptr_id", target["gpoint"], "gentity_ptr_id", {"approximate": F.lit(False)}
    )
    texts = ("name", "short_name", "remarks", "name_alt", "short_name_alt", "remarks_alt")
    target["gentity"] = insert_missing(
        target["gpoint"], "gentity_ptr_id", target["gentity"], "id", {t: F.lit("") for t in texts}
    )


def completed_entities(entities: DataFrame, links: DataFrame, source: Source) -> DataFrame:
    """Texts, division, basin and remarks of the entities behind the assets.

    Everything known about a source key is gathered first, then joined to the
    links and to the entities once each. The texts reset the divisions; details
    and basins then set them again.
    """
    def keyed(df: DataFrame, *columns: Column | str) -> DataFrame:
        return df.select(F.col("id").alias("_source"), *columns)

    texts = entity_texts()
    around = gathered(
        "_source",
        text=keyed(source["gentities"], *[c.alias(n) for n, c in texts.items()]),
        detail=keyed(source["gentities_real"], *DETAILS),
        point=keyed(source["gpoints"], "basin"),
    )
    known = links.select("entity_id", "source_id").join(around, F.col("source_id") == F.col("_source"))

    no_id = F.lit(None).cast("int")
    sets = {n: if_present("text", new(f"text.{n}"), n) for n in texts}
    reset = {c: if_present("text", no_id, c) for c in ("water_basin_id", "water_division_id", "political_division_id")}
    for language, column in enumerate(("remarks", "remarks_alt")):
        sets[column] = if_present("detail", detail_remarks(sets[column], language), sets[column])
    basin = if_present("point", new("point.basin") + BASINS, reset["water_basin_id"])
    sets["water_basin_id"] = if_present("detail", basin, reset["water_basin_id"])
    sets["water_division_id"] = reset["water_division_id"]
    sets["political_division_id"] = if_present("detail", detail_division(), reset["political_division_id"])
    return update_from(entities, known, {"id": "entity_id"}, sets)


def cross_sections(sections: DataFrame, drawings: str = DRAWING_EXTENSION) -> DataFrame:
    """Cross sections with the path of their drawing, '' where there is none.

    ``drawings`` is the extension of the files that ``extract_drawings`` writes.
    """
    rows = project(sections, {
        "id": "id", "closed": or_default("closed", False), "dimensions": or_default("dimensions", ""),
        "drawing_file": drawing_path(f"gentityfile/{DRAWING_NAME}", "id", drawings), "xsection_type_id": "xsection_type",
    })
    undrawn = sections.where(F.col("drawing").isNull())
    return update_where_in(rows, "id", undrawn, "id", {"drawing_file": F.lit("")})


def set_details(target: Target, asset: Asset, source: Source, links: DataFrame) -> None:
    """The asset's own fields, set from the source row that each asset is linked to."""
    details = asset.details(source)
    special = details.select(F.col("id").alias("_id"), *[c.alias(n) for n, c in asset.fields.items()])
    owned = links.select("asset_id", "source_id").join(special, F.col("source_id") == F.col("_id"))
    target[asset.table] = update_from(
        target[asset.table], owned, {"gisentity_ptr_id": "asset_id"}, {n: new(n) for n in asset.fields}
    )


def _add_curves(target: Target, asset: Asset, source: Source, links: DataFrame) -> None:
    for subtype in asset.curves:
        curves = source["curves"].where(F.col("terminal_subtable") == subtype)
        owned = curves.join(links, F.col("gentity") == F.col("source_id"))
        target.add("gentitygenericdata", project(owned, {**curve_columns(CURVES[subtype][0]), "gentity_id": "asset_id"}))


def add_series(target: Target, source: Source, links: DataFrame) -> None:
    """Series metadata under new ids, and the records under the same ids."""
    owned = loadable_series(source["timeseries"]).join(links, F.col("gentity") == F.col("source_id"))
    rows = project(with_old_id(owned), {
        "old_id": "old_id", "gentity_id": "entity_id", **series_columns(), "hidden": False,
    })
    added = target.add("timeseries", rows, serial=["old_id", "gentity_id"], unique=True)
    target.add("ts_records", carry_records(source["ts_records"], added, old_id="old_id"))


def load(spark: SparkSession, asset: Asset, source: Source, existing: Source, media_name: str) -> Tables:
    """The target tables with one kind of asset loaded.

    ``existing`` holds the registry ``gisentity``, the asset's own table and the
    entity tables; ``media_name`` begins the names of the extracted files.
    """
    target = Target(existing)
    for table, name in asset.lookups.items():
        target.add(table, copy_lookup(source[name]))
    if asset.table == "gisaqueductnode":
        roots = source["conduits"].where(F.col("parent").isNull()).select("id")
        groups = source["gentities"].join(roots, "id")
        target.add("gisaqueductgroup", project(groups, {
            "id": "id", "descr": or_default("name", ""), "descr_alt": or_default("name_en", ""),
        }))
    if asset.curve_types:
        target.add("gentitygenericdatatype", literal_table(
            spark, asset.curve_types, "id int, descr string, descr_alt string, file_extension string"
        ))
    if asset.table == "gisaqueductline":
        target.add("gisxsection", cross_sections(source["xsections"]))
    if asset.table == "gisborehole":
        add_missing_boreholes(target, source["boreholes"])

    any_links = link_assets(target[asset.table], target["gisentity"], asset.pointer, asset.link)
    links = link_assets(target[asset.table], target["gisentity"], asset.pointer, asset.link, asset.kind)

    target["gentity"] = completed_entities(target["gentity"], any_links, source)
    if asset.altitude:
        heights = any_links.join(source["gentities"].select("id", "alt"), F.col("source_id") == F.col("id"))
        target["gpoint"] = update_from(
            target["gpoint"], heights.select("entity_id", "alt"), {"gentity_ptr_id": "entity_id"}, {"altitude": new("alt")}
        )
    if asset.length:
        lengths = any_links.join(source["glines"].select("id", "length"), F.col("source_id") == F.col("id"))
        target["gline"] = update_from(
            target["gline"], lengths.select("entity_id", "length"), {"gentity_ptr_id": "entity_id"}, {"length": new("length")}
        )

    media = source["gentities_multimedia"].join(any_links, F.col("id") == F.col("source_id"))
    files = project(media, {"gentity_id": "asset_id", "_num": "num", **file_columns(media_name)})
    target.add("gentityfile", files, serial=["gentity_id", "_num"], unique=True, helpers=["_num"])

    if asset.shared:
        shared = links.join(source["boreholes_springs"], F.col("source_id") == F.col("id"))
        target["gisboreholespring"] = update_from(
            target["gisboreholespring"],
            shared.select("entity_id", "water_use", "water_user", "land_use", "continuous_flow"),
            {"gpoint_ptr_id": "entity_id"},
            {
                "water_use_id": new("water_use"), "water_user_id": new("water_user"),
                "land_use_id": new("land_use"), "continuous_flow": new("continuous_flow"),
            },
        )
    set_details(target, asset, source, links)
    _add_curves(target, asset, source, any_links)
    add_series(target, source, links)
    target["next_ids"] = target.next_ids(sorted(target.tables))
    return target.tables


def fill_curves(documents: DataFrame, source: Source) -> DataFrame:
    """The curve table with all four kinds of point lists filled in."""
    for subtype, (_, order, numbers, points) in CURVES.items():
        curves = source["curves"].where(F.col("terminal_subtable") == subtype)
        documents = write_documents(documents, curve_documents(curves, source[points], order, numbers))
    return documents


def extract_drawings(
    sections: DataFrame, path: str, mode: str = "error", drawings: str = DRAWING_EXTENSION
) -> Written:
    """Write the cross sections' drawings, as stored, one file each, under the names that ``cross_sections`` gives."""
    return write_blobs(sections, path, drawing_path(DRAWING_NAME, "id", drawings), "drawing", mode)
