import datetime as dt
import os

import pytest
from fixtures import NATIONAL, frames, rows
from pyspark.sql import functions as F

from stationflow.plans import national
from stationflow.plans.common import violations


@pytest.fixture(scope="module")
def source(spark):
    return frames(spark, NATIONAL)


@pytest.fixture(scope="module")
def loaded(spark, source):
    existing = {"lentity": spark.createDataFrame([(50, "", "")], "id int, remarks string, remarks_alt string")}
    return national.load(spark, source, 7, existing, one_person_per_name=False)


def test_areas(loaded):
    ids = rows(loaded["gentity"].where(F.col("id") < 5000), "id", "name", "short_name")
    assert ids == [
        (303, "Attica", "Attica"), (405, "Athens", "ATH"), (506, "Attica water", "AW"), (1011, "Kifisos", ""),
        (1012, "Other", ""), (1421, "Upper", ""), (1422, "Orphan", ""),
    ]
    assert rows(loaded["garea"], "gentity_ptr_id") == [(303,), (405,), (506,), (1011,), (1012,), (1421,), (1422,)]
    assert rows(loaded["politicaldivision"]) == [(303, 84, ""), (405, 303, "")]
    assert rows(loaded["waterdivision"]) == [(506,)]
    assert rows(loaded["waterbasin"], "garea_ptr_id", "water_division_id", "parent_id") == [
        (1011, 506, None), (1012, None, None), (1421, 506, 1011),
    ]
    assert rows(loaded["gentityaltcode"], "gentity_id", "type_id", "value", "id") == [
        (1011, 1, "40", 1), (1012, 1, "41", 2), (1421, 1, "401", 3), (1422, 1, "991", 4),
    ]


def test_lookups(loaded):
    assert rows(loaded["timestep"], "id", "length_minutes", "length_months") == [(1, 10, 0), (6, 0, 1), (7, 0, 12)]
    assert rows(loaded["stationtype"]) == [(2, "rain", "")]
    assert loaded["unitofmeasurement"].count() == 14
    assert loaded["unitofmeasurement_variables"].count() == 61
    assert rows(loaded["organization"], "lentity_ptr_id", "name", "acronym") == [(7, "Power company", "PC")]


def test_series(loaded):
    assert rows(
        loaded["timeseries"], "id", "gentity_id", "unit_of_measurement_id", "remarks", "instrument_id", "time_step_id", "actual_offset_months"
    ) == [(1, 501030, 3, "", 123, 1, 0), (2, 200017, None, "note", 2, None, None), (3, 501015, 2, "", None, None, None)]


def test_stations(loaded):
    stations = loaded["gentity"].where(F.col("id") > 5000)
    assert rows(stations, "id", "water_basin_id", "water_division_id", "political_division_id", "name", "remarks") == [
        (200017, 1012, None, 405, "Three", ""), (501015, None, None, None, "Anonymous", "c"), (501030, 1011, 506, 405, "One", ""),
    ]
    points = rows(loaded["gpoint"], "gentity_ptr_id", "abscissa", "ordinate", "srid", "altitude")
    assert points[0] == (200017, None, None, None, None)
    assert points[1][0] == 501015 and points[1][3:] == (4326, 20.0)
    assert points[1][1] == pytest.approx(38.208333333) and points[1][2] == pytest.approx(23.5)
    assert points[2] == (501030, 450000.0, 4200000.0, 2100, 10.0)
    assert rows(loaded["station"], "gpoint_ptr_id", "owner_id", "type_id", "is_active", "is_automatic") == [
        (200017, 7, 2, False, False), (501015, 7, 1, False, False), (501030, 7, 2, True, False),
    ]
    assert rows(loaded["instrument"], "id", "station_id", "type_id", "is_active", "remarks") == [(123, 501030, 1, False, "")]


def test_people(loaded, spark, source):
    assert rows(loaded["person"], "lentity_ptr_id", "last_name", "first_name") == [(51, "Papas", "Nikos"), (52, "Papas", "Nikos")]
    assert rows(loaded["lentity"], "id") == [(7,), (50,), (51,), (52,)]
    assert rows(loaded["overseer"], "station_id", "person_id") == [(501015, 51), (501015, 52), (501030, 51), (501030, 52)]
    single = national.load(spark, source, 7)
    assert rows(single["person"], "lentity_ptr_id", "last_name") == [(8, "Papas")]
    assert rows(single["overseer"], "station_id", "person_id") == [(501015, 8), (501030, 8)]


def test_references(loaded):
    found = dict(rows(violations(loaded)))
    # the fixture has no country
    assert "politicaldivision.parent_id" in {k for k, n in found.items() if n} and not found["overseer.person_id"]
    assert {"overseer.person_id", "waterbasin.parent_id", "instrument.station_id"} <= set(found)
    broken = loaded | {"station": loaded["station"].withColumn("gpoint_ptr_id", F.lit(-1))}
    assert dict(rows(violations(broken)))["station.gpoint_ptr_id"] == broken["station"].count()


def test_next_ids(loaded):
    assert dict(rows(loaded["next_ids"])) == {
        "instrumenttype": 3, "gentity": 501031, "lentity": 53, "stationtype": 3, "timestep": 8, "variable": 1000,
        "timezone": 2, "unitofmeasurement": 15, "timeseries": 4, "instrument": 124,
    }


def test_record_files(spark, source, tmp_path):
    out = str(tmp_path / "export")
    written = national.export_records(source, out)
    assert {k: tuple(v) for k, v in written.items()} == {
        "timeseries": (4, 7), "cloud_observations": (1, 1), "weather_observations": (1, 1),
    }
    folder = f"{out}/timeseries"
    assert sorted(n for n in os.listdir(folder) if not n.startswith(".")) == ["00001.data", "00002.data", "00003.data", "123456.data"]
    read = lambda name: open(f"{out}/{name}", "rb").read().decode()
    assert read("timeseries/00001.data") == "2000-01-01 00:30,10,F X\r\n2000-01-01 01:00,2.5,\r\n"
    assert read("timeseries/00002.data") == "2000-01-01 00:00,,\r\n"
    assert read("timeseries/00003.data") == "2000-01-01 00:00,225,\r\n2000-01-02 00:00,, Y\r\n2000-01-03 00:00,0,F\r\n"
    assert read("timeseries/123456.data") == "2000-01-01 00:00,,\r\n"
    assert read("cloud_observations/00004.data") == "2000-01-01 08:05,,Cu/3/500 /1/ // St//9\r\n"
    assert read("weather_observations/00005.data") == "2000-01-01 08:00,,10//3\r\n"
    records = national.load_records(spark, folder)
    assert rows(records.where("id = 1")) == [
        (1, dt.datetime(2000, 1, 1, 0, 30), 10.0, "F X"), (1, dt.datetime(2000, 1, 1, 1, 0), 2.5, ""),
    ]
    with pytest.raises(FileExistsError):
        national.export_records(source, out)
    national.export_records(source, out, mode="overwrite")


def test_images(spark, source, tmp_path):
    no_files = spark.createDataFrame([], "id int")
    types = spark.createDataFrame([(4, "text/plain")], "id int, mime_type string")
    files, new_types = national.load_images(source["stimages"], no_files, types)
    assert rows(new_types) == [(4, "text/plain"), (5, "image/jpeg")]
    assert rows(files, "gentity_id", "id", "file_type_id", "content") == [
        (200017, 1, 5, "200017-1.jpg"), (200017, 2, 5, "200017-2.jpg"), (501030, 3, 5, "501030-3.jpg"),
    ]
    assert tuple(national.write_images(files, str(tmp_path / "images"))) == (3, 3)
    assert open(tmp_path / "images" / "200017-2.jpg", "rb").read() == b"\xff\xd8three"
    loaded, _ = national.load_images(source["stimages"], spark.createDataFrame([(1,)], "id int"), types)
    assert loaded.count() == 0
