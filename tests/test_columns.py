import datetime as dt
import random

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.functions.decode import (
    actual_offset_months,
    compass_degrees,
    decode,
    decode_members,
    interval_type,
    nominal_offset_months,
    prefecture_division,
    series_kind,
    time_step,
)
from stationflow.functions.geo import degrees_from_text
from stationflow.functions.keys import divided_key, guarded_key, in_range
from stationflow.functions.records import is_month_start, merged_flags, phase_minutes
from stationflow.functions.text import (
    append_remark,
    extension,
    first_stamp,
    id_from_file_name,
    media_path,
    minute_stamp,
    minute_text,
    number_text,
    point_line,
    truncated,
    word,
)
from stationflow.plans.national import station_key


def evaluate(spark, schema, data, *columns):
    """The columns' values per input row, in input order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "_row int, " + schema)
    found = df.select("_row", *[c.alias(f"c{i}") for i, c in enumerate(columns)]).orderBy("_row").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in found]


def test_remark(spark):
    data = [("a", "v"), ("", "v"), ("a", None), (None, "v")]
    assert evaluate(spark, "r string, v string", data, append_remark("r", "L", "v")) == ["a\nL: v", "\nL: v", "a\n", None]


def test_degrees(spark):
    found = evaluate(
        spark, "t string", [("38 12",), ("38 12 30",), ("38 12 30.50",), ("xx",), (None,), ("38 12   ",)],
        degrees_from_text("t"), degrees_from_text("t", trimmed=True),
    )
    assert found[0] == pytest.approx((38.2, 38.2))
    assert found[1] == pytest.approx((38.2083333333,) * 2)
    assert found[2] == pytest.approx((38.2084722222,) * 2)
    assert found[3] == (None, None) and found[4] == (None, None)


def test_keys(spark):
    assert evaluate(spark, "k bigint", [(5010150001,), (5010150002,), (2000170001,), (None,)], station_key("k")) == [501030, 501015, 200017, None]
    assert evaluate(spark, "k int", [(-199,), (199,)], divided_key("k", 100)) == [-1, 1]
    assert evaluate(spark, "k int", [(3,), (0,), (-1,), (None,)], guarded_key("k", 400), guarded_key("k", default=1)) == [
        (403, 3), (None, 1), (None, 1), (None, 1),
    ]
    assert evaluate(spark, "k int", [(1,), (7,), (8,), (None,)], in_range("k", 1, 7), in_range("k", 1, 7, F.lit(0))) == [
        (1, 0), (7, 0), (None, None), (None, None),
    ]


def test_compass_and_flags(spark):
    data = [("SW",), ("WS",), ("N",), ("XX",), ("",), ("0",), (None,)]
    assert evaluate(spark, "v string", data, compass_degrees("v")) == ["225", "225", "0", "", "", "0", None]
    data = [(None, "X"), ("F", "X"), ("F", "0"), ("F", None), ("F", ""), (None, None)]
    assert evaluate(spark, "f string, a string", data, merged_flags("f", "a")) == [" X", "F X", "F", "F", "F", ""]


def test_series_codes(spark):
    assert evaluate(spark, "s int", [(6,), (7,), (3,), (None,)], time_step("s"), actual_offset_months("s")) == [
        (None, 0), (6, 0), (3, 0), (None, 0),
    ]
    assert evaluate(spark, "s int", [(4,), (5,)], actual_offset_months("s")) == [1, 12]
    assert evaluate(spark, "v int", [(i,) for i in (1, 2, 3, 4, 5, 6, 7, None)], interval_type("v")) == [None, 1, 2, 4, 3, 2, None, None]
    data = [(True, True), (True, False), (True, None), (False, True), (None, True)]
    assert evaluate(spark, "s boolean, h boolean", data, nominal_offset_months("s", "h")) == [9, 0, 0, None, None]
    assert evaluate(spark, "k int", [(1,), (2,), (None,)], series_kind("k", True)) == ["Raw data", "Processed data", "Processed data"]


def test_maps(spark):
    codes = [(k,) for k in (2, 94, 8, 0, 95, -1, None)]
    assert evaluate(spark, "k int", codes, prefecture_division("k")) == [453, 449, None, None, None, None, None]
    assert len(values.PREFECTURE_DIVISIONS) == 51 and len(set(values.PREFECTURE_DIVISIONS.values())) == 51
    assert not {454, 455, 456} & set(values.PREFECTURE_DIVISIONS.values())
    listed = [i for ids in values.INSTRUMENT_TYPE_MEMBERS.values() for i in ids]
    assert sorted(listed) == [i for i in range(1, 112) if i not in range(31, 40)]
    assert evaluate(spark, "k int", [(76,), (35,), (111,)], decode_members("k", values.INSTRUMENT_TYPE_MEMBERS)) == [8, None, 9]
    assert evaluate(spark, "k string", [("a",), ("z",), (None,)], decode("k", {"a": 1})) == [1, None, None]
    assert evaluate(spark, "k int", [(5_000_000,), (1,), (2,)], decode("k", {1: "x", 5_000_000: "y"})) == ["y", "x", None]
    assert sum(len(v) for v in values.UNIT_VARIABLES.values()) == 61


def test_paths_and_text(spark):
    path = media_path("gentityfile/imported_file_", "i", "n", extension("t"))
    assert evaluate(spark, "i int, n int, t int", [(5, 2, 1), (5, 2, 99), (5, 2, 8)], path) == [
        "gentityfile/imported_file_1005-2.jpg", None, "gentityfile/imported_file_1005-2.bmp",
    ]
    assert evaluate(spark, "t string", [("ab cd ef",), ("ab",), ("",)], word("t", 1), word("t", 2), truncated("t", 4)) == [
        ("ab", "cd", "ab c"), ("ab", "", "ab"), ("", "", ""),
    ]
    assert evaluate(spark, "v double", [(10.0,), (0.5,), (-3.0,), (None,)], number_text("v")) == ["10", "0.5", "-3", None]
    assert evaluate(spark, "a double, b int", [(1.0, 2), (-0.0000001, 3)], point_line("a", "b")) == ["1.000000,2.000000", "-0.000000,3.000000"]
    assert evaluate(spark, "n string", [("00042.data",), ("123456.000003.data",)], id_from_file_name("n")) == [42, 123456]
    rng = random.Random(5)
    plain = [rng.uniform(-1, 1) * 10 ** rng.randint(-10, 21) for _ in range(500)]
    plain += [0.0, 1e7, 12345678.9, 1e-5, 0.001, 9999999.0, 1e21, 123456789012345680.0]
    texts = evaluate(spark, "v double", [(x,) for x in plain], number_text("v"))
    assert [float(t) for t in texts] == plain and not any("E" in t for t in texts)
    assert texts[-8:] == ["0", "10000000", "12345678.9", "0.00001", "0.001", "9999999", "1" + "0" * 21, "123456789012345680"]
    numbers = [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 14) for _ in range(500)]
    numbers += [0.0, -0.0, 1e-6, 5e-7, 4.9e-7, -1e-9, 1e11, 1e22, -1e300, 99999999999.999999, 123456.7890625, 0.1, 1 / 3]
    numbers += [0.1234565, 0.0078125, 10000000000.3, 0.9999995, 2.0**53 + 1, rng.randrange(10**7) / 128, rng.randrange(10**9) * 5e-7]
    for number, text in zip(numbers, evaluate(spark, "a double", [(x,) for x in numbers], point_line("a"))):
        assert text == "%f" % number if abs(number) < 2**63 else float(text) == number
    with pytest.raises(Exception, match="without a number"):
        evaluate(spark, "a double", [(None,)], point_line("a"))


def test_moments(spark):
    moments = [(dt.datetime(2008, 1, 31, 23, 5),), (dt.datetime(2008, 2, 1),), (dt.datetime(2008, 3, 30, 3, 30, 20),)]
    phases = evaluate(spark, "t timestamp_ntz", moments, *[phase_minutes("t", s) for s in (10, 60, 1440)])
    assert phases[0] == (5, 5, 1385)
    assert evaluate(spark, "t timestamp_ntz", moments, is_month_start("t")) == [False, True, False]
    # A session zone in which 2008-03-30 03:30 does not exist must not shift anything.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Athens")
    try:
        texts = evaluate(spark, "t timestamp_ntz", moments, minute_text("t"), minute_text(minute_stamp(minute_text("t"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert texts == [("2008-01-31 23:05",) * 2, ("2008-02-01 00:00",) * 2, ("2008-03-30 03:30",) * 2]
    assert evaluate(spark, "c string", [("2008-01-31T23:05,1,x\n2009",), ("",), (None,)], first_stamp("c")) == ["2008-01-31T23:05", "", None]
    assert rows(spark.range(1).select(minute_stamp(F.lit("2008-01-31T23:05")))) == [(dt.datetime(2008, 1, 31, 23, 5),)]


def test_fixed_maps():
    """The comparison SQL is made of these values, so their counts and sums are held here."""
    places = values.PREFECTURE_DIVISIONS
    assert (len(places), sum(places), sum(places.values())) == (51, 2262, 21797)
    assert {k: (len(x), sum(x)) for k, x in values.INSTRUMENT_TYPE_MEMBERS.items()} == {
        1: (20, 1068), 2: (19, 1109), 3: (10, 604), 4: (10, 551), 5: (10, 561), 6: (10, 571), 7: (10, 581),
        8: (1, 76), 9: (10, 621), 10: (1, 79), 11: (1, 80),
    }
    pairs = values.UNIT_VARIABLES
    assert (len(pairs), sum(map(len, pairs.values())), sum(map(sum, pairs.values()))) == (14, 61, 2553)
