import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from metricloom.functions import (
    duration_seconds,
    instant_from_utc,
    publish_month,
    publish_month_number,
    publish_year,
    utc_day,
    with_snapshot_time,
)

PERIODS = [
    ("1640995199999", "2021", "12", "December"),
    ("1640995200000", "2022", "01", "January"),
    ("0", "1970", "01", "January"),
    ("-1", "1969", "12", "December"),
    (None, "n/a", "n/a", None),
    ("abc", None, None, None),
    ("", None, None, None),
    (" 5", None, None, None),
    ("1.5", None, None, None),
    ("99999999999999999999", None, None, None),
    ("253402300799999", "9999", "12", "December"),
    ("253402300800000", "+10000", "01", "January"),
    ("-62135596800001", "0000", "12", "December"),
    ("123\n", None, None, None),
    ("9999999999999999", "+318857", "05", "May"),
    ("99999999999999999", "+3170843", "11", "November"),
    ("-99999999999999999", "-3166904", "02", "February"),
    ("9223372036854775807", "+292278994", "08", "August"),
    ("-9223372036854775808", "-292275055", "05", "May"),
    ("9223372036854775808", None, None, None),
    # The moment Los Angeles skips an hour.
    ("1710064800000", "2024", "03", "March"),
]

DURATIONS = [
    ("PT1H2M3S", 3723),
    ("PT5M\n", None),
    ("PT1H3S", 3603),
    ("PT1H2M", 3720),
    ("PT1H", 3600),
    ("PT2M3S", 123),
    ("PT2M", 120),
    ("PT3S", 3),
    ("PT0S", 0),
    ("P1D", 0),
    ("P0D", 0),
    ("P1W", 0),
    ("PT", 0),
    ("", 0),
    ("P1DT2H3M4S", None),
    ("P1DT5M", None),
    ("P1M", None),
    ("PT5S3M", None),
    ("PT99999999999H", None),
    ("PT2000000H", None),
    (None, None),
]


def test_periods(column, zone, ansi):
    found = column([p[0] for p in PERIODS], "string", publish_year("c"), publish_month_number("c"), publish_month("c"))
    assert found == [p[1:] for p in PERIODS]


def test_periods_against_the_calendar(column, zone):
    rng = random.Random(5)
    start = datetime(1, 1, 1, tzinfo=timezone.utc)
    moments = [start + timedelta(milliseconds=rng.randrange(315_537_897_600_000)) for _ in range(3000)]
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    texts = [str((m - epoch) // timedelta(milliseconds=1)) for m in moments]
    found = column(texts, "string", publish_year("c"), publish_month("c"))
    assert found == [(f"{m.year:04d}", m.strftime("%B")) for m in moments]


def test_durations(column, ansi):
    assert column([d[0] for d in DURATIONS], "string", duration_seconds("c")) == [d[1] for d in DURATIONS]


@pytest.mark.parametrize(
    ("wall", "micros"),
    [
        ("2024-03-10 02:30:00.123456", 1_710_037_800_123_456),  # skipped in Los Angeles
        ("2024-11-03 01:30:00", 1_730_597_400_000_000),  # twice in Los Angeles
        ("1969-12-31 23:59:59.999999", -1),
    ],
)
def test_instant_from_utc(spark, zone, wall, micros):
    row = spark.sql(f"SELECT timestamp_ntz'{wall}' AS c").select(F.unix_micros(instant_from_utc("c"))).first()
    assert row[0] == micros


def test_utc_day(spark, zone):
    texts = ["2024-03-10T23:59:59.999Z", "2024-03-11T00:00:00Z", "1969-12-31T23:59:59Z"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    days = rows.select("i", utc_day(F.col("c").cast("timestamp")).cast("string")).orderBy("i").collect()
    assert [d[1] for d in days] == ["2024-03-10", "2024-03-11", "1969-12-31"]


def test_snapshot_time(spark, zone):
    rows = spark.range(2)
    for at in ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)):
        timed = with_snapshot_time(rows, at)
        assert timed.columns == ["current_time", "id"]
        assert {r[0] for r in timed.select(F.unix_millis("current_time")).collect()} == {1_704_164_645_000}
    now = with_snapshot_time(rows).select("current_time").distinct().collect()
    assert len(now) == 1
