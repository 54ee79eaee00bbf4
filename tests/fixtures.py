"""Small source schemas, one row list per table."""

from __future__ import annotations

import datetime as dt

D = dt.date
TS = dt.datetime

LOOKUP = "id int, descr string, descr_en string"


def frames(spark, tables):
    return {name: spark.createDataFrame(rows, schema) for name, (schema, rows) in tables.items()}


def rows(df, *columns):
    """The rows' values, sorted, None first."""
    picked = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(picked, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


NATIONAL = {
    "instruments": ("instrtype int, instrtpname string", [(1, "gauge"), (2, "vane")]),
    "pol_districts": ("pdid int, pdname string", [(0, "unknown"), (3, "Attica")]),
    "services": ("srvid int, srvname string, srvcodename string", [(7, "Power company", "PC")]),
    "states": ("sttid int, sttname string, sttcodename string, pdid int", [(5, "Athens", "ATH", 3), (6, "none", "N", 0)]),
    "stcategories": ("stcatid int, stcatname string", [(0, "unknown"), (2, "rain")]),
    "timesteps": ("timeresid int, minutes int, tmrname string", [(1, 10, "ten"), (6, 0, "monthly")]),
    "variables": ("varid int, varname string", [(7, "rain"), (4, "wind"), (999, "odd")]),
    "water_districts": ("wtrid int, wtrname string, wtrcodename string", [(6, "Attica water", "AW"), (0, "unknown", "")]),
    "basins": ("wbid int, wbname string, wtrid int, wbcode int", [(0, "unknown", 0, 0), (11, "Kifisos", 6, 40), (12, "Other", 0, 41)]),
    "sub_basins": (
        "wsbid int, wsbname string, wtrid int, wbcode int, wsbcode int",
        [(21, "Upper", 6, 40, 401), (22, "Orphan", 6, 99, 991), (0, "unknown", 0, 0, 0)],
    ),
    "raw_timeseries_info": (
        "id int, geoinfoid bigint, varid int, comments string, instrid bigint, timeresid int",
        [(1, 5010150001, 7, None, 12345, 1), (2, 2000170001, 999, "note", 200, 9), (3, 5010150002, 4, "", None, None)],
    ),
    "stationconfig": (
        "stconfigid bigint, stationid bigint, instrtype int, instartdate date, inenddate date, notes string",
        [(12300, 5010150001, 1, D(1990, 1, 1), None, None), (99900, 9990000001, 2, None, None, "foreign")],
    ),
    "stations": (
        "stationid bigint, srvid int, wbid int, wtrid int, sttid int, stcatid int, stationname string, comments string, "
        "x double, y double, altitude double, phi string, lamda string, st_isactiv int, startdate date, enddate date, observer string",
        [
            (5010150001, 7, 11, 6, 5, 2, "One", None, 450000.0, 4200000.0, 10.0, "", "", 1, D(1980, 1, 1), None, "Papas Nikos"),
            (5010150002, 7, 0, 0, 0, 0, None, "c", 0.0, 0.0, 20.0, "38 12 30", "23 30", 0, None, None, "Papas Nikos"),
            (2000170001, 7, 12, 0, 5, 2, "Three", "", None, None, None, "00 00 00", None, None, None, None, ""),
            (9990000001, 8, 11, 6, 5, 2, "Foreign", None, 1.0, 1.0, 1.0, "", "", 1, None, None, "Else One"),
        ],
    ),
    "stimages": (
        "stationid bigint, stimgdate date, stimgdata binary",
        [(5010150001, D(2001, 1, 1), b"\xff\xd8one"), (2000170001, D(2001, 1, 2), b"\xff\xd8two"), (2000170001, D(2002, 1, 2), b"\xff\xd8three")],
    ),
    "raw_timeseries_float_data": (
        "id int, datein timestamp_ntz, flag string, value double, additional string",
        [
            (1, TS(2000, 1, 1, 1, 0), None, 2.5, None), (1, TS(2000, 1, 1, 0, 30), "F", 10.0, "X"),
            (2, TS(2000, 1, 1), "", None, "0"), (3, TS(2000, 1, 1), "lost", 1.0, None),
        ],
    ),
    "raw_timeseries_string_data": (
        "id int, datein timestamp_ntz, flag string, value string, additional string",
        [(3, TS(2000, 1, 1), None, "SW", None), (3, TS(2000, 1, 2), None, "??", "Y"), (3, TS(2000, 1, 3), "F", "0", None), (123456, TS(2000, 1, 1), None, None, None)],
    ),
    "cloud_observation": (
        "id int, datein timestamp_ntz, " + ", ".join(f"cloud_type{i} string, cloud_pct{i} string, cloud_height{i} string" for i in range(1, 5)),
        [(4, TS(2000, 1, 1, 8, 5), "Cu", "3", "500", None, "1", None, None, None, None, "St", None, "9")],
    ),
    "weather_observation": (
        "id int, datein timestamp_ntz, current_weather string, past_weather1 string, past_weather2 string",
        [(5, TS(2000, 1, 1, 8, 0), "10", None, "3")],
    ),
}

WEATHER = {
    "vcountries": ("descr int, descr_en string, code string", [(87, "Greece", "GR"), (1, "Albania", "AL")]),
    "vpeople": ("id int, last_name_en string, first_names_en string", [(1, "Smith", "Ann")]),
    "vstypes": ("id int, descr_en string", [(1, "Meteorological")]),
    "vstations": (
        "id int, name int, name_en string, address_en string, x double, y double, altitude double, owner int, stype int, "
        "station_active boolean, telemetry boolean",
        [(1, 500, "Zografou", "Campus", 1.0, 2.0, 3.0, 1, 1, True, False), (2, 501, "Other", None, 4.0, 5.0, None, 1, 1, False, True)],
    ),
    "string_contents": ("id int, language string, string string", [(500, "gr", "Ζωγράφου"), (500, "en", "Zografou"), (501, "en", "Other")]),
    "vinstruments": (
        "id int, station int, instrument_active boolean, name_en string",
        [(6, 1, True, "a"), (79, 1, True, "b"), (31, 1, False, "c"), (111, 2, True, "d"), (77, 2, True, "e")],
    ),
    "vmunits": ("id int, symbol string, name_en string", [(1, "mm", "millimetre")]),
    "vvars": ("id int, descr_en string", [(1, "Rainfall")]),
    "vtimeseries": (
        "id int, gentity int, var int, munit int, precision int, name_en string, remarks_en string, instrument int, strict boolean, "
        "tstep_unit int, length int",
        [
            (1, 1, 1, 1, 1, "ten", "", 6, True, 1, 10), (2, 1, 1, 1, 1, "month", "", 6, False, 2, 1),
            (3, 1, 1, 1, 1, "year", "", 6, None, 2, 12), (4, 1, 1, 1, 1, "odd", "", 6, True, 3, 10), (5, 1, 1, 1, 1, "none", "", 6, True, 1, 12),
        ],
    ),
    "timeseries_records": ("id int, top string, middle binary, bottom string", [(1, None, b"m", "b"), (2, "t", None, None)]),
}

_REAL = "id int, prefecture int, location string, location_en string, municipality string, municipality_en string"
_ENTITIES = (
    "id int, name string, descr string, remarks string, name_en string, descr_en string, remarks_en string, "
    "terminal_subtable string, x double, y double, alt double"
)
_MEDIA = (
    "id int, num int, ftype int, multimedia_name string, multimedia_name_en string, remarks string, remarks_en string, mdate date, multimedia binary"
)
_SERIES = (
    "id int, gentity int, var int, unit int, name string, name_en string, precision int, remarks string, remarks_en string, ttype int, "
    "instrument int, tstep int, var_type int, tstep_strict boolean, hydrological_year boolean, toffset int, synth boolean"
)
_CURVES = "id int, gentity int, name string, name_en string, remarks string, remarks_en string, terminal_subtable string"
_CHUNKS = "id int, num int, top string, middle binary, bottom string"

UTILITY = {
    "services": ("id int, descr string, short_descr string, descr_en string, short_descr_en string", [(1, "Water", None, None, "W")]),
    "gentities": (_ENTITIES, [
        (1, "n" * 210, "d" * 60, "r", "en", None, None, "stations", 1.0, 2.0, 3.0),
        (2, None, None, None, None, None, "x", "stations", 4.0, 5.0, 6.0),
        (3, "Basin", None, None, None, None, None, "basins", None, None, None),
        (4, "Pump", None, None, None, None, None, "pumps_generators", None, None, None),
    ]),
    "gentities_real": (_REAL, [(1, 2, "loc", None, None, "mun"), (2, 99, None, None, None, None), (4, 1, "l", "l", "m", "m")]),
    "gpoints": ("id int, basin int", [(1, 3), (2, None), (77, 3)]),
    "gareas": ("id int, area double", [(3, 12.5), (4, 1.0)]),
    "stations": (
        "id int, service int, ssubtype int, stype int, station_active boolean, telemetry boolean, start_date date, end_date date, "
        "service_code string, miet_code string, network_code string, wmo_code string, other_code string, observer string, observer_en string",
        [
            (1, 1, None, 4, True, False, D(2000, 1, 1), None, "S1", None, "N1", None, "", "Obs", "Obs en"),
            (2, 1, 5, 4, False, True, None, None, None, "M2", None, "W2", None, None, None),
        ],
    ),
    "basins": ("id int, parent int, water_district int, miet_code string", [(3, None, 7, "B3"), (5, 3, None, None)]),
    "gentities_events": (
        "id int, event_date date, event_type int, event_user string, report string, report_en string",
        [(1, D(2001, 1, 1), 1, None, "rep", None), (1, D(2001, 1, 1), 1, None, "rep", None), (2, D(2000, 1, 1), 1, "u", None, "r")],
    ),
    "gentities_multimedia": (_MEDIA, [
        (1, 2, 1, "pic", None, None, "r", D(2002, 1, 1), b"jpeg"), (2, 1, 99, None, None, None, None, None, b"none"),
        (4, 1, 7, None, None, None, None, None, b"foreign"),
    ]),
    "curves": (_CURVES, [
        (1, 1, "c", None, None, "r", "hq_curves"), (2, 2, None, None, None, None, "hq_curves"), (3, 1, None, None, None, None, "other"),
    ]),
    "hq_curves": (
        "id int, num int, log boolean, ext boolean, coffset double, start_date date, end_date date",
        [(1, 2, True, False, 0.5, D(2001, 1, 1), D(2002, 1, 1)), (1, 1, False, True, 0.0, D(2000, 1, 1), D(2001, 1, 1)),
         (1, 3, False, True, 0.0, None, D(2001, 1, 1)), (1, 4, False, False, 1.0, D(2003, 1, 1), D(2004, 1, 1))],
    ),
    "hq_points": ("id int, curve_num int, h double, q double", [(1, 1, 2.0, 20.0), (1, 1, 1.0, 10.0), (1, 2, 1.5, 7.25), (1, 3, 9.0, 9.0)]),
    "instruments": (
        "id int, station int, itype int, name string, name_en string, remarks string, remarks_en string, manufacturer string, model string, "
        "instrument_active boolean, start_date date, end_date date",
        [(1, 1, 1, None, None, None, None, None, "m", None, None, None)],
    ),
    "timeseries": (_SERIES, [
        (1, 1, 1, None, "s", None, 2, None, None, 1, 1, 1, 2, True, True, None, False),
        (2, 2, 1, 4, None, None, 2, "r", "re", 2, None, 7, 1, True, None, 5, False),
        (3, 1, 1, 4, None, None, 2, None, None, 2, None, 6, 6, False, True, 0, False),
        (4, 1, 1, 4, None, None, 2, None, None, 3, None, 4, 6, False, True, 0, False),
        (5, 1, 1, 4, None, None, 2, None, None, 1, None, 4, 6, False, True, 0, True),
        (6, 4, 1, 4, None, None, 2, None, None, 1, None, 4, 6, False, True, 0, False),
    ]),
    "ts_records": (_CHUNKS, [
        (1, 0, None, b"m", "2008-01-31 23:05,1,\r\n2008-01-31 23:15,2,"), (1, 1, "second", None, "x"), (2, 0, "t", None, ""), (6, 0, "t", None, "b"),
    ]),
    "stypes": (LOOKUP, [(4, "a", None)]),
    "gevent_types": (LOOKUP, [(1, None, "event")]),
    "itypes": (LOOKUP, [(1, "i", "i")]),
    "vars": (LOOKUP, [(1, "v", None)]),
    "ftypes": (LOOKUP + ", mime_type string", [(1, "jpg", None, "image/jpeg"), (2, None, None, None)]),
    "units": (LOOKUP + ", symbol string", [(4, "u", None, None)]),
}

# Registry and entity tables shared by the asset tests: asset id, entity id and source id differ.
ASSET_TARGET = {
    "gisentity": (
        "id int, gtype_id int, gis_id int, original_gentity_id int",
        [(101, 1, 11, None), (102, 2, 12, None), (103, 3, 13, None), (104, 4, None, 14), (105, 5, 15, None), (106, 6, None, 16), (107, 7, None, 17)],
    ),
    "gentity": (
        "id int, water_basin_id int, water_division_id int, political_division_id int, name string, short_name string, remarks string, "
        "name_alt string, short_name_alt string, remarks_alt string",
        [(i, 9, 9, 9, "old", "old", "old", "", "", "") for i in range(201, 208)] + [(300, 9, 9, 9, "kept", "kept", "kept", "", "", "")],
    ),
    "gpoint": ("gentity_ptr_id int, approximate boolean, altitude double", [(i, False, None) for i in range(201, 206)]),
    "gline": ("gentity_ptr_id int, length double", [(206, None)]),
    "gisboreholespring": (
        "gpoint_ptr_id int, water_use_id int, water_user_id int, land_use_id int, continuous_flow double", [(201, None, None, None, None), (204, None, None, None, None)],
    ),
}

ASSET_SOURCE = {
    "gentities": (_ENTITIES, [
        (i, f"name{i}", None, "rem", None, "de", None, "x", None, None, float(i)) for i in (11, 12, 13, 14, 15, 16, 17, 18)
    ]),
    "gentities_real": (_REAL, [(i, 2, "loc", "loc", None, None) for i in (11, 12, 13, 14, 15, 16, 18)]),
    "gpoints": ("id int, basin int", [(i, 40) for i in (11, 12, 13, 14)]),
    "gentities_multimedia": (_MEDIA, [(i, 1, 7, None, "m", None, None, None, b"x") for i in (11, 12, 16)]),
    "timeseries": (_SERIES, [
        (900 + i, i, 1, None, None, None, 1, None, None, 1, None, 4, 3, False, False, None, False) for i in range(11, 18)
    ]),
    "ts_records": (_CHUNKS, [(900 + i, n, None, None, f"b{n}") for i in (11, 16) for n in (0, 1)]),
    "curves": (_CURVES, [
        (1, 17, "hsv", None, None, None, "reservoir_hsvb"), (2, 17, None, None, None, None, "reservoir_leakage"),
        (3, 17, None, None, None, None, "reservoir_spill"), (4, 16, None, None, None, None, "duct_discharge_capacity"), (5, 17, None, None, None, None, "hq_curves"),
    ]),
    "reservoir_hsvb": ("id int, h double, s double, v double", [(1, 2.0, 3.0, 4.0), (1, 1.0, 2.5, 3.5)]),
    "reservoir_leakage": (
        "id int, month int, value_a double, value_b double, value_c double, value_e double", [(2, 10, 1.0, 2.0, 3.0, 4.0), (2, 9, 0.5, 0.0, 0.0, 0.125)],
    ),
    "reservoir_spill": ("id int, h double, q double", [(3, 2.0, 20.0), (3, 1.0, 10.0)]),
    "duct_discharge_capacity": ("id int, head double, discharge double", []),
    "boreholes_springs": ("id int, water_use int, water_user int, land_use int, continuous_flow double", [(11, 1, 2, 3, 4.5), (14, 5, 6, 7, 8.5)]),
    "glines": ("id int, length double, alt2 double", [(16, 77.5, 5.0)]),
    "conduits": (
        "id int, parent int, xsection int, area double, width double, depth double, slope double, roughness_coef double, "
        "roughness_coef_type int, bank_slope double, measure_discharge boolean, measure_stage boolean, start_position double, end_position double",
        [
            (15, 18, None, None, None, None, None, None, None, None, None, True, 1.0, 2.0),
            (16, 18, 8, 1.0, 2.0, 3.0, 4.0, 5.0, 6, 7.0, True, None, 8.0, 9.0), (18, None, None, None, None, None, None, None, None, None, None, None, None, None),
        ],
    ),
    "aqueducts": (
        "id int, leakage_coef double, duct_segment_type int, discharge_capacity double, duct_flow_type int, duct_status int, repers string, "
        "repers_en string, pipe_mat int",
        [(15, None, 3, None, 4, 5, None, "r", None), (16, 0.5, 3, 2.5, 4, 5, "rr", None, 9)],
    ),
}
