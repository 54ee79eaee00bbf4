import pytest
from fixtures import UTILITY, frames, rows

from stationflow.plans import utility

CODES = {1: "service_code", 2: "miet_code", 3: "network_code", 4: "wmo_code", 5: "other_code"}
SEED = (
    "id int, water_basin_id int, water_division_id int, political_division_id int, name string, short_name string, remarks string, "
    "name_alt string, short_name_alt string, remarks_alt string"
)


@pytest.fixture(scope="module")
def source(spark):
    return frames(spark, UTILITY)


@pytest.fixture(scope="module")
def loaded(spark, source):
    types = spark.createDataFrame([(i, c, c) for i, c in CODES.items()], "id int, descr string, descr_alt string")
    seed = {"gentity": spark.createDataFrame([(453, None, None, None, "Seed", "Seed", "", "", "", "")], SEED)}
    return utility.load(spark, source, types, CODES, "imported_file_", seed)


def test_entities(loaded):
    found = {r["id"]: r for r in loaded["gentity"].collect()}
    assert sorted(found) == [453, 1001, 1002, 1003]
    one, two, basin = found[1001], found[1002], found[1003]
    assert (len(one["name"]), len(one["short_name"])) == (200, 50)
    assert one["remarks"] == "r\nΤοποθεσία: loc\n\nΠαρατηρητής: Obs"
    assert one["remarks_alt"] == "\n\nMunicipality: mun\nObserver: Obs en"
    assert (one["political_division_id"], one["water_basin_id"], one["water_division_id"]) == (453, 1003, 507)
    assert two["name"] == "" and two["remarks"] == "\n\n\n" and two["remarks_alt"] == "x\n\n\n"
    assert (two["political_division_id"], two["water_basin_id"], two["water_division_id"]) == (None, None, None)
    assert basin["remarks"] == "" and found[453]["remarks"] == ""


def test_points_and_basins(loaded):
    assert rows(loaded["gpoint"], "gentity_ptr_id", "abscissa", "srid") == [(1001, 1.0, 2100), (1002, 4.0, 2100)]
    assert rows(loaded["garea"], "gentity_ptr_id", "area") == [(1003, 12.5)]
    assert rows(loaded["waterbasin"], "garea_ptr_id", "parent_id", "water_division_id") == [(1003, None, 507), (1005, 1003, None)]
    assert rows(loaded["station"], "gpoint_ptr_id", "type_id") == [(1001, 4), (1002, 5)]


def test_codes_events_files(loaded):
    assert rows(loaded["gentityaltcode"], "id", "gentity_id", "type_id", "value") == [
        (1, 1001, 1, "S1"), (2, 1002, 2, "M2"), (3, 1003, 2, "B3"), (4, 1001, 3, "N1"), (5, 1002, 4, "W2"), (6, 1001, 5, ""),
    ]
    events = rows(loaded["gentityevent"], "id", "gentity_id", "user", "report", "report_alt")
    assert events == [(1, 1001, "", "rep", ""), (2, 1001, "", "rep", ""), (3, 1002, "u", "", "r")]
    assert rows(loaded["gentityfile"], "id", "gentity_id", "file_type_id", "content") == [
        (1, 1001, 1, "gentityfile/imported_file_1001-2.jpg"), (2, 1002, 99, None),
    ]


def test_series(loaded):
    series = {r["id"]: r for r in loaded["timeseries"].collect()}
    assert sorted(series) == [1, 2, 3]
    one, two, three = series[1], series[2], series[3]
    assert one["unit_of_measurement_id"] == 1001 and one["remarks"] == "\nΤύπος: Πρωτογενής" and one["remarks_alt"] == "\nType: Raw data"
    assert (one["time_step_id"], one["interval_type_id"], one["nominal_offset_minutes"], one["nominal_offset_months"]) == (1, 1, 0, 9)
    assert two["remarks"] == "r\nΤύπος: Επεξεργασμένη" and two["remarks_alt"] == "re\nType: Processed data"
    assert (two["time_step_id"], two["interval_type_id"], two["nominal_offset_months"], two["actual_offset_minutes"]) == (6, None, 0, 5)
    assert (three["time_step_id"], three["interval_type_id"], three["nominal_offset_minutes"], three["nominal_offset_months"]) == (None, 2, None, None)
    assert rows(loaded["ts_records"], "id", "top") == [(1, ""), (2, "t")]
    fixed = utility.fix_phases(loaded["timeseries"], loaded["ts_records"])
    assert rows(fixed, "id", "nominal_offset_minutes") == [(1, 5), (2, 0), (3, None)]
    assert rows(loaded["unitofmeasurement"], "id", "symbol") == [(4, ""), (1001, "-")]


def test_curves(loaded, source):
    filled = utility.fill_curves(loaded["gentitygenericdata"], source)
    content = dict(rows(filled, "id", "content"))
    header = 'Delimiter=","\nDecimalSeparator="."\nDateFormat="yyyy-mm-dd hh:nn"\n'
    assert content[2] == header + "Count=0\n\n"
    assert content[1] == (
        header + "Count=3\n\n"
        "StartDate=2000-01-01 00:00\nEndDate=2001-01-01 00:00\nStartMonth=1\nEndMonth=12\nExtension=True\nLogarithmic=False\n"
        "Offset=0.000000\nPointsCount=2\n\n1.000000,10.000000\n2.000000,20.000000\n\n"
        "StartDate=2001-01-01 00:00\nEndDate=2002-01-01 00:00\nStartMonth=1\nEndMonth=12\nExtension=False\nLogarithmic=True\n"
        "Offset=0.500000\nPointsCount=1\n\n1.500000,7.250000\n\n"
        "StartDate=2003-01-01 00:00\nEndDate=2004-01-01 00:00\nStartMonth=1\nEndMonth=12\nExtension=False\nLogarithmic=False\n"
        "Offset=1.000000\nPointsCount=0\n\n\n"
    )


def test_next_ids(loaded):
    next_ids = dict(rows(loaded["next_ids"]))
    assert next_ids["gentity"] == 1004 and next_ids["gentityevent"] == 4 and next_ids["unitofmeasurement"] == 1002


def test_extract_files(source, tmp_path):
    out = tmp_path / "media"
    written = utility.extract_files(source["gentities_multimedia"], str(out), "imported_file_")
    assert tuple(written) == (2, 2)
    assert (out / "imported_file_1001-2.jpg").read_bytes() == b"jpeg"
