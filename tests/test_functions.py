from datetime import datetime

from snapline.functions import (Cadence, clamp_lag, effective_interval, flag, is_night, iso_text,
                                round_tenth, status_of, text_timestamp)


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_flag_three_valued(spark):
    got = one(spark, flag("v"), [("OUI",), ("NON",), ("oui",), (None,)], "v string")
    assert got == [True, False, False, None]


def test_text_timestamp(spark):
    rows = [("2024-03-01T10:00:00+02:00",), ("2024-03-01T10:00:00",), ("bad",), ("",), ("2024-03-01",)]
    got = one(spark, text_timestamp("v"), rows, "v string")
    assert got == [datetime(2024, 3, 1, 8), datetime(2024, 3, 1, 10), None, None, datetime(2024, 3, 1)]


def test_iso_text_keeps_micros(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 5, 10, 0, 0, 123456),)], "t timestamp_ntz")
    assert df.select(iso_text("t")).first()[0] == "2024-01-05T10:00:00.123456+00:00"


def test_round_half_even(spark):
    assert one(spark, round_tenth("v"), [(0.25,), (0.35,)], "v double") == [0.2, 0.4]


def test_status_bounds(spark):
    got = one(spark, status_of("a", 120.0), [(120.0,), (120.1,), (360.0,), (360.1,), (None,)], "a double")
    assert got == ["healthy", "degraded", "degraded", "down", "down"]


def test_clamp_lag(spark):
    df = spark.createDataFrame([(10, 4), (4, 10), (None, 3)], "h long, c long")
    assert [r[0] for r in df.select(clamp_lag("h", "c")).collect()] == [6, 0, None]


def test_night_mode(spark):
    # UTC instants; Paris is UTC+1 in winter, UTC+2 from 2024-03-31 03:00 local.
    rows = [(datetime(2024, 1, 5, 1, 0),),    # Fri 02:00 local
            (datetime(2024, 1, 5, 3, 59),),   # Fri 04:59
            (datetime(2024, 1, 5, 4, 0),),    # Fri 05:00
            (datetime(2024, 1, 6, 2, 0),),    # Sat 03:00
            (datetime(2024, 3, 31, 1, 30),),  # Sun, DST day
            (datetime(2024, 4, 2, 0, 30),)]   # Tue 02:30 local (UTC+2)
    got = one(spark, is_night("t"), rows, "t timestamp_ntz")
    assert got == [True, True, False, False, False, True]
    never = Cadence(start_hour=5, end_hour=2)
    assert one(spark, is_night("t", never), rows, "t timestamp_ntz") == [False] * 6
    assert one(spark, is_night("t", Cadence(enabled=False)), rows, "t timestamp_ntz") == [False] * 6
    got = one(spark, effective_interval("t"), rows[:3], "t timestamp_ntz")
    assert got == [240, 240, 60]
