import pytest
from fixtures import ASSET_SOURCE, ASSET_TARGET, LOOKUP, frames, rows

from stationflow.plans import assets

MEDIA = "imported_file_"


def run(spark, name, source_tables, target_tables):
    asset = assets.assets()[name]
    lookups = {s: (LOOKUP, [(1, "d", None)]) for s in asset.lookups.values()}
    source = frames(spark, {**ASSET_SOURCE, **lookups, **source_tables})
    target = frames(spark, {**ASSET_TARGET, **target_tables})
    return assets.load(spark, asset, source, target, MEDIA), source


def child_schema(asset, extra):
    """The asset's own table: pointers first, then its fields."""
    return ", ".join([f"{asset.pointer} int", "gisentity_ptr_id int", *extra])


def check_common(loaded, entity, asset_id, source, basin=None, real=True):
    found = {r["id"]: r for r in loaded["gentity"].collect()}
    assert found[300]["name"] == "kept"
    own = found[entity]
    assert own["name"] == f"name{source}" and own["short_name_alt"] == "de"
    assert own["political_division_id"] == (453 if real else None)
    assert own["water_basin_id"] == basin and own["water_division_id"] is None
    assert own["remarks"] == ("rem\nΤοποθεσία: loc\n" if real else "rem")
    assert [found[i]["name"] for i in range(201, 208) if i != entity] == ["old"] * 6
    series = loaded["timeseries"].collect()
    assert [(r["id"], r["old_id"], r["gentity_id"], r["hidden"], r["actual_offset_months"]) for r in series] == [
        (1, 900 + source, entity, False, 1)
    ]


def test_pumps(spark):
    fields = "id int, pump_type int, is_irrig boolean, is_pump boolean, pump_active boolean, is_generator boolean, generator_active boolean, " \
        "pump_num int, pump_discharge double, generator_num int, total_power double, generator_discharge double, pump_energy double, generator_energy double"
    own = fields.replace("id int, pump_type int", "gpoint_ptr_id int, gisentity_ptr_id int, pump_type_id int")
    loaded, _ = run(
        spark, "pumps",
        {"pumps_generators": (fields, [(12, 3, True, True, None, False, None, 2, 1.5, None, 7.0, None, None, None)])},
        {"gispump": (own, [(202, 102, 1, None, None, None, None, None, 9, None, None, None, None, None, None)])},
    )
    check_common(loaded, 202, 102, 12, basin=1040)
    assert rows(loaded["gispump"], "gpoint_ptr_id", "pump_type_id", "is_irrig", "pump_num", "total_power") == [(202, 3, True, 2, 7.0)]
    assert rows(loaded["gentityfile"], "id", "gentity_id", "content") == [(1, 102, "gentityfile/imported_file_1012-1.png")]
    assert rows(loaded["gispumptype"]) == [(1, "d", "")]


def test_refineries(spark):
    columns = "capacity double, peak_capacity double, storage double, overflow_stage double, outlet_level double"
    loaded, _ = run(
        spark, "refineries", {"treatment_plants": ("id int, " + columns, [(13, 1.0, 2.0, 3.0, 4.0, None)])},
        {"gisrefinery": ("gpoint_ptr_id int, gisentity_ptr_id int, " + columns, [(203, 103, 9.0, 9.0, 9.0, 9.0, 9.0)])},
    )
    check_common(loaded, 203, 103, 13, basin=1040)
    assert rows(loaded["gisrefinery"]) == [(203, 103, 1.0, 2.0, 3.0, 4.0, None)]
    assert rows(loaded["gpoint"].where("altitude is not null"), "gentity_ptr_id", "altitude") == [(203, 13.0)]


def test_springs(spark):
    loaded, _ = run(
        spark, "springs", {"springs": ("id int, dstype int, hgeo_info int, is_continuous boolean", [(14, 2, 3, None)])},
        {"gisspring": (
            "gisboreholespring_ptr_id int, gisentity_ptr_id int, dstype_id int, hgeo_info_id int, is_continuous boolean",
            [(204, 104, None, None, True)],
        )},
    )
    check_common(loaded, 204, 104, 14, basin=1040)
    assert rows(loaded["gisspring"]) == [(204, 104, 2, 3, False)]
    assert rows(loaded["gisboreholespring"]) == [(201, None, None, None, None), (204, 5, 6, 7, 8.5)]


BOREHOLE = (
    "pmeter_length double, pmeter_diameter double, borehole_depth double, pipe_depth double, water_depth double, value_t double, "
    "value_s double, value_b double, value_k double, threshold_a double, threshold_b double, continuous_stage double, test_flow double, "
    "test_stage double, begin_works date, end_works date, pump_discharge double, pump_ratio double"
)


def test_boreholes(spark):
    source_row = lambda i: (i, None, 4, 5, 6, *[1.5] * 14, None, None, 2.5, 3.5)
    loaded, _ = run(
        spark, "boreholes",
        {"boreholes": ("id int, has_pmeter boolean, pmeter_type int, drill_type int, pipe_mat int, " + BOREHOLE, [source_row(11), source_row(18)])},
        {"gisborehole": (
            "gisboreholespring_ptr_id int, gisentity_ptr_id int, `group` string, has_pmeter boolean, pmeter_type_id int, drill_type_id int, "
            "pipe_mat_id int, " + BOREHOLE,
            [(201, 101, "g", True, None, None, None, *[None] * 18)],
        )},
    )
    # Borehole 18 was unknown: it gets registry row 108 and entity 301.
    assert rows(loaded["gisentity"].where("gtype_id = 1"), "id", "gis_id", "original_gentity_id") == [(101, 11, None), (108, 18, None)]
    assert rows(loaded["gisborehole"], "gisboreholespring_ptr_id", "gisentity_ptr_id", "group", "has_pmeter", "drill_type_id", "pump_ratio") == [
        (201, 101, "g", False, 5, 3.5), (301, 108, "", False, 5, 3.5),
    ]
    assert rows(loaded["gisboreholespring"], "gpoint_ptr_id", "water_use_id") == [(201, 1), (204, None), (301, None)]
    assert rows(loaded["gpoint"].where("gentity_ptr_id in (201, 301)")) == [(201, False, 11.0), (301, False, 18.0)]
    found = {r["id"]: r for r in loaded["gentity"].collect()}
    assert found[301]["name"] == "name18" and found[301]["political_division_id"] == 453 and found[301]["water_basin_id"] is None
    assert found[201]["water_basin_id"] == 1040 and found[300]["name"] == "kept"
    # All chunks of a series are carried.
    assert rows(loaded["ts_records"]) == [(1, "", None, "b0"), (1, "", None, "b1")]
    next_ids = dict(rows(loaded["next_ids"]))
    assert next_ids["gisentity"] == 109 and next_ids["gentity"] == 302


def test_boreholes_with_null_link(spark):
    """A registry row without a source key makes NOT IN true for no borehole."""
    loaded, _ = run(
        spark, "boreholes",
        {"boreholes": ("id int, has_pmeter boolean, pmeter_type int, drill_type int, pipe_mat int, " + BOREHOLE, [(18, None, 4, 5, 6, *[None] * 18)])},
        {
            "gisentity": ("id int, gtype_id int, gis_id int, original_gentity_id int", [(101, 1, 11, None), (102, 1, None, None)]),
            "gisborehole": (
                "gisboreholespring_ptr_id int, gisentity_ptr_id int, `group` string, has_pmeter boolean, pmeter_type_id int, drill_type_id int, "
                "pipe_mat_id int, " + BOREHOLE,
                [(201, 101, "g", True, None, None, None, *[None] * 18), (202, 102, "g", True, None, None, None, *[None] * 18)],
            ),
        },
    )
    assert rows(loaded["gisentity"], "id") == [(101,), (102,)]


AQUEDUCT = "measure_discharge boolean, measure_stage boolean, start_position double, end_position double, duct_segment_type_id int, " \
    "duct_status_id int, repers string, repers_en string, group_id int"


def test_nodes(spark):
    loaded, _ = run(
        spark, "aqueduct_nodes", {},
        {"gisaqueductnode": ("gpoint_ptr_id int, gisentity_ptr_id int, " + AQUEDUCT, [(205, 105, None, None, None, None, None, None, None, None, None)])},
    )
    check_common(loaded, 205, 105, 15)
    assert rows(loaded["gisaqueductnode"]) == [(205, 105, False, True, 1.0, 2.0, 3, 5, "", "r", 18)]
    assert rows(loaded["gisaqueductgroup"]) == [(18, "name18", "")]
    assert sorted(k for k in loaded if k.startswith("gisduct")) == ["gisductflowtype", "gisductsegmenttype", "gisductstatustype"]


SEGMENT = "xsection_id int, area double, width double, depth double, slope double, roughness_coef double, roughness_coef_type_id int, " \
    "bank_slope double, leakage_coef double, discharge_capacity double, duct_flow_type_id int, pipe_mat_id int, alt1 double, alt2 double"


def test_segments(spark, tmp_path):
    sections = ("id int, closed boolean, dimensions string, xsection_type int, drawing binary", [(8, None, None, 2, b"BM"), (9, True, "1x1", 2, None), (10, True, "", 2, b"")])
    loaded, source = run(
        spark, "aqueduct_segments", {"xsections": sections},
        {"gisaqueductline": (f"gline_ptr_id int, gisentity_ptr_id int, {AQUEDUCT}, {SEGMENT}", [(206, 106, *[None] * 23)])},
    )
    check_common(loaded, 206, 106, 16)
    assert rows(loaded["gisaqueductline"]) == [
        (206, 106, True, False, 8.0, 9.0, 3, 5, "rr", "", 18, 8, 1.0, 2.0, 3.0, 4.0, 5.0, 6, 7.0, 0.5, 2.5, 4, 9, 16.0, 5.0)
    ]
    assert rows(loaded["gisxsection"]) == [
        (8, False, "", "gentityfile/imported_xsection_8.png", 2), (9, True, "1x1", "", 2), (10, True, "", "gentityfile/imported_xsection_10.png", 2),
    ]
    assert rows(loaded["gline"]) == [(206, 77.5)]
    assert rows(loaded["gentitygenericdata"], "id", "gentity_id", "data_type_id", "content") == [(4, 106, 5, "")]
    assert rows(loaded["gentityfile"], "gentity_id") == [(106,)]
    assert tuple(assets.extract_drawings(source["xsections"], str(tmp_path / "drawings"))) == (1, 1)
    assert (tmp_path / "drawings" / "imported_xsection_8.png").read_bytes() == b"BM"


def test_reservoirs(spark):
    columns = ", ".join(f"{c} double" for c in (
        "inflow_mean", "inflow_max", "inflow_min", "runoff_mean", "runoff_max", "runoff_min", "volume_max", "dead_volume"))
    loaded, source = run(
        spark, "reservoirs", {"reservoirs": ("id int, " + columns, [(17, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0)])},
        {"gisreservoir": ("garea_ptr_id int, gisentity_ptr_id int, " + columns, [(207, 107, *[None] * 8)])},
    )
    check_common(loaded, 207, 107, 17, real=False)
    assert rows(loaded["gisreservoir"]) == [(207, 107, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0)]
    assert rows(loaded["gentitygenericdatatype"], "id", "file_extension") == [(2, "txt"), (3, "txt"), (4, "txt")]
    assert rows(loaded["gentitygenericdata"], "id", "gentity_id", "descr", "data_type_id") == [(1, 107, "hsv", 2), (2, 107, "", 3), (3, 107, "", 4)]
    filled = assets.fill_curves(loaded["gentitygenericdata"], source)
    assert dict(rows(filled, "id", "content")) == {
        1: "1.000000,2.500000,3.500000\n2.000000,3.000000,4.000000",
        2: "0.500000,0.000000,0.000000,0.125000\n1.000000,2.000000,3.000000,4.000000",
        3: "1.000000,10.000000\n2.000000,20.000000",
    }


@pytest.mark.parametrize("name", ["springs", "boreholes", "pumps", "refineries", "aqueduct_nodes", "aqueduct_segments", "reservoirs"])
def test_links_use_equi_joins(spark, name):
    from stationflow.operators.joins import link_assets

    asset = assets.assets()[name]
    children = spark.createDataFrame([(1, 2)], f"{asset.pointer} int, gisentity_ptr_id int")
    links = link_assets(children, frames(spark, ASSET_TARGET)["gisentity"], asset.pointer, asset.link, asset.kind)
    source = frames(spark, ASSET_SOURCE)
    entities = frames(spark, ASSET_TARGET)["gentity"]
    plan = assets.completed_entities(entities, links, source)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_kinds_are_distinct():
    kinds = {a.kind for a in assets.assets().values()}
    assert kinds == set(range(1, 8))
