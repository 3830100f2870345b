import pytest
from pyspark.sql import functions as F

from metricloom.operators.snapshots import daily_change, latest_per_day
from metricloom.plans.reports import REPORTS, report

SNAPSHOTS = [
    # id, country, time, views
    ("a", "RS", "2024-01-01T01:00:00Z", 10),
    ("a", "RS", "2024-01-01T23:59:59Z", 20),  # the last of the day counts
    ("b", "RS", "2024-01-01T10:00:00Z", 5),
    ("b", "RS", "2024-01-01T10:00:00Z", 7),  # of the same moment, the larger counts
    ("a", "RS", "2024-01-02T00:00:00Z", 27),
    ("b", "RS", "2024-01-02T00:00:00Z", 27),
    ("a", "RS", "2024-01-05T00:00:00Z", 0),  # days between without a snapshot
    ("a", "RS", "2024-01-06T00:00:00Z", 9),  # from zero there is no percentage
    ("c", None, "2024-01-01T00:00:00Z", 4),
    ("c", None, "2024-01-02T00:00:00Z", 2),
]


@pytest.fixture
def snapshots(spark):
    rows = spark.createDataFrame(SNAPSHOTS, "channel_id string, country string, t string, view_count long")
    return rows.withColumn("current_time", F.col("t").cast("timestamp")).repartition(4)


def test_latest_per_day(snapshots, zone):
    rows = latest_per_day(snapshots, "channel_id", ["country"], "view_count")
    found = {(r.channel_id, str(r.snapshot_date)): r.view_count for r in rows.collect()}
    assert found[("a", "2024-01-01")] == 20 and found[("b", "2024-01-01")] == 7
    assert len(found) == 8


def test_daily_change(snapshots, zone):
    rows = report("a26", snapshots).collect()
    found = {(r.country, str(r.snapshot_date)): (r.view_count_sum, r.percent_change) for r in rows}
    assert found == {
        ("RS", "2024-01-01"): (27, None),
        ("RS", "2024-01-02"): (54, 100.0),
        ("RS", "2024-01-05"): (0, -100.0),
        ("RS", "2024-01-06"): (9, None),
        (None, "2024-01-01"): (4, None),
        (None, "2024-01-02"): (2, -50.0),
    }


def test_daily_change_reduces_before_each_shuffle(snapshots):
    plan = daily_change(snapshots, "channel_id", ["country"], "view_count")._jdf.queryExecution().executedPlan().toString()
    # The hash table over key, day and attributes, then the few that are left, then the daily sums.
    assert plan.count("partial_max") == 2 and plan.count("partial_sum") == 1
    assert "SinglePartition" not in plan


def test_shares(spark):
    rows = spark.createDataFrame([("en", 1), ("en", 3), ("sr", 4), (None, 0)], "language string, like_count int")
    found = {r.language: tuple(r)[1:] for r in report("a15", rows).collect()}
    assert found == {"en": (2, 4, 50.0, 50.0), "sr": (1, 4, 25.0, 50.0), None: (1, 0, 25.0, 0.0)}


def test_shares_of_nothing(spark):
    rows = spark.createDataFrame([("en", 0)], "language string, like_count int")
    assert report("a15", rows).first().like_count_sum_percent is None
    assert report("a15", rows.limit(0)).collect() == []


def test_shares_pass_no_rows_through_one_task(spark):
    rows = spark.createDataFrame([("en", 1)], "language string, like_count int")
    plan = report("a15", rows)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_author_profile_with_renamed_author(spark):
    rows = spark.createDataFrame([("x", 1, 4), ("x", 2, 5), ("y", None, None)], "author string, comment_like_count int, text_length int")
    found = {tuple(r) for r in report("a25", rows, comment_author_channel_name="author").collect()}
    assert found == {("x", 2, 3, 4.5), ("y", 1, None, None)}


def test_year_and_month_come_from_the_publish_time(spark, zone):
    rows = spark.createDataFrame([("2020-12-31T23:30:00Z",), ("2021-01-01T00:30:00Z",), (None,)], "t string")
    table = rows.select(F.col("t").cast("timestamp").alias("published_at"))
    found = {tuple(r) for r in report("a09", table).collect()}
    assert found == {("2020", "December", 1), ("2021", "January", 1), ("n/a", None, 1)}


def test_sums_do_not_overflow_an_int(spark):
    rows = spark.range(3).select(F.lit("p").alias("playlist_title"), F.lit(2_000_000_000).alias("videos_count"))
    assert report("a07", rows).first().videos_count_sum == 6_000_000_000


def test_all_reports_are_there():
    assert list(REPORTS) == [f"a{n:02d}" for n in range(1, 29)]
    assert all(r.title and r.groups for r in REPORTS.values())
