import datetime as dt

import pytest
from fixtures import WEATHER, frames, rows

from stationflow.operators.quality import month_start_violations
from stationflow.plans import weather


@pytest.fixture(scope="module")
def loaded(spark):
    return weather.load(spark, frames(spark, WEATHER))


def test_entities(loaded):
    assert rows(loaded["gentity"], "id", "name", "short_name", "remarks", "name_alt", "political_division_id") == [
        (1, "Ζωγράφου", "Ζωγράφου", "Campus", "Zografou", 187), (2, None, None, None, "Other", 187),
        (101, "Albania", "Albania", "", "", None), (187, "Greece", "Greece", "", "", None),
    ]
    assert rows(loaded["politicaldivision"]) == [(101, None, "al"), (187, None, "gr")]
    assert rows(loaded["person"], "lentity_ptr_id", "last_name", "first_name", "initials") == [(1, "Smith", "Ann", "")]
    assert rows(loaded["station"], "gpoint_ptr_id", "owner_id", "is_active", "is_automatic") == [(1, 1, True, False), (2, 1, False, True)]


def test_instruments(loaded):
    assert rows(loaded["instrument"], "id", "type_id") == [(6, 5), (31, None), (77, 2), (79, 10), (111, 9)]
    assert loaded["instrumenttype"].count() == 11
    assert loaded["unitofmeasurement_variables"].count() == 14


def test_series(loaded):
    assert rows(
        loaded["timeseries"], "id", "time_step_id", "nominal_offset_minutes", "nominal_offset_months", "actual_offset_minutes", "actual_offset_months"
    ) == [(1, 1, 0, 0, 0, 0), (2, 4, None, None, -60, 1), (3, 5, None, None, -60, 12), (4, None, 0, 0, 0, None), (5, None, 0, 0, 0, None)]
    assert rows(loaded["ts_records"], "id", "top", "bottom") == [(1, "", "b"), (2, "t", None)]
    assert dict(rows(loaded["next_ids"]))["timeseries"] == 6


def test_no_nested_loop(spark):
    source = frames(spark, WEATHER)
    steps = weather.load(spark, source)["timestep"]
    plan = weather.series_rows(source["vtimeseries"], steps)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_shift(spark, loaded):
    records = spark.createDataFrame(
        [(2, dt.datetime(2008, 1, 31, 23, 0), 1.0), (3, dt.datetime(2008, 1, 1, 0, 0), 2.0), (1, dt.datetime(2008, 1, 31, 23, 0), 3.0)],
        "id int, ts timestamp_ntz, value double",
    )
    shifted = weather.shift_monthly(records, loaded["timeseries"])
    assert rows(shifted) == [(2, dt.datetime(2008, 2, 1), 1.0), (3, dt.datetime(2008, 1, 1, 1), 2.0)]
    assert rows(month_start_violations(shifted), "id") == [(3,)]
