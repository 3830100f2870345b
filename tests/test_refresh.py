"""All reports of a table from one scan, and daily changes kept up to date."""

import pytest
from pyspark.sql import functions as F

from metricloom.functions import utc_day
from metricloom.jobs import main
from metricloom.plans.changes import snapshots_of, update_changes
from metricloom.plans.refresh import grouped_reports, grouped_sets, refreshed
from metricloom.plans.reports import REPORTS, report
from metricloom.schemas import ENTITIES
from metricloom.session import scratch_path
from metricloom.sources import files
from metricloom.sources.tables import TableStore, read_table, write_snapshot, write_table
from metricloom.workload.bindings import reported
from tests.conftest import SMALL


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("entity", ENTITIES)
def test_slices_equal_their_reports(spark, entity):
    df = reported(spark, SMALL, entity)
    charts = refreshed(entity, df)
    assert charts.keys() == grouped_reports(entity).keys() and charts
    for name, rows in charts.items():
        alone = report(name, df)
        assert rows.columns == alone.columns and rows_of(rows) == rows_of(alone)


def test_missing_groups_are_not_taken_for_groups_left_out(spark):
    rows = spark.createDataFrame([(None, "x"), ("c", None), (None, None)], "category string, language string")
    charts = refreshed("videos", rows.withColumns({"like_count": F.lit(1), "duration_seconds": F.lit(2)}), ["a12", "a15", "a18", "a19", "a20"])
    assert rows_of(charts["a12"]) == rows_of(spark.createDataFrame([(None, 2), ("c", 1)], "a string, b int"))
    assert charts["a19"].count() == 3 and charts["a15"].count() == 2


def test_one_scan_and_partial_sums(spark):
    plan = grouped_sets(reported(spark, SMALL, "comments"), grouped_reports("comments"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1 and plan.count("Exchange") == 1 and "partial_count" in plan


def test_refresh_from_the_command_line(spark, tmp_path):
    store = TableStore(str(tmp_path))
    write_table(reported(spark, SMALL, "playlists"), store, "playlists")
    main(["refresh", "playlists", "--tables", str(tmp_path)], spark)
    assert rows_of(read_table(spark, store, "playlists_a09")) == rows_of(report("a09", read_table(spark, store, "playlists")))


def taken(spark, *rows):
    frame = spark.createDataFrame(rows, "channel_id string, country string, t string, view_count long").withColumn("current_time", F.col("t").cast("timestamp"))
    return frame.withColumn("snapshot_date", utc_day("current_time")).drop("t")


def compare(spark, store):
    whole = report("a26", read_table(spark, store, "channels").drop("snapshot_date"))
    columns = ["country", "snapshot_date", "view_count_sum", "percent_change"]
    assert rows_of(read_table(spark, store, "a26_changes").select(*columns)) == rows_of(whole.select(*columns))


def test_changes_equal_the_whole_recomputation(spark):
    store = TableStore(scratch_path(spark, "store"))
    first = taken(
        spark, ("a", "RS", "2024-01-01T10:00:00Z", 10), ("b", None, "2024-01-01T11:00:00Z", 4), ("a", "RS", "2024-01-03T00:00:00Z", 20),
        ("c", "FR", "2024-01-02T00:00:00Z", 7), ("c", "FR", "2024-01-09T00:00:00Z", 14), ("b", None, "2024-01-05T00:00:00Z", 5),
    )
    write_snapshot(first, store, "channels")
    update_changes(spark, store, store, "a26", ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05", "2024-01-09"])
    compare(spark, store)
    # A late day between two others, and a day that is taken again with other rows and groups.
    write_snapshot(taken(spark, ("a", "RS", "2024-01-02T10:00:00Z", 40), ("d", "DE", "2024-01-02T10:00:00Z", 1)), store, "channels")
    assert update_changes(spark, store, store, "a26", ["2024-01-02"]) == ["2024-01-02", "2024-01-03", "2024-01-09"]
    compare(spark, store)
    assert update_changes(spark, store, store, "a26", ["2024-01-02"]) == ["2024-01-02", "2024-01-03"]
    compare(spark, store)
    # A day whose snapshots are gone.
    files.delete(spark, f"{store.path('channels')}/snapshot_date=2024-01-01")
    assert update_changes(spark, store, store, "a26", ["2024-01-01"]) == ["2024-01-01", "2024-01-02", "2024-01-05"]
    compare(spark, store)
    assert update_changes(spark, store, store, "a26", []) == []


def test_an_update_that_failed_half_way_is_repeated(spark, monkeypatch):
    from metricloom.plans import changes

    store = TableStore(scratch_path(spark, "store"))
    write_snapshot(taken(spark, ("a", "RS", "2024-01-01T10:00:00Z", 10), ("a", "RS", "2024-01-04T10:00:00Z", 30)), store, "channels")
    update_changes(spark, store, store, "a26", ["2024-01-01", "2024-01-04"])
    write_snapshot(taken(spark, ("b", "FR", "2024-01-01T10:00:00Z", 10)), store, "channels")
    replace = changes._replace_days

    def lost(spark, rows, store, name, days):
        if name == "a26_changes":
            raise RuntimeError("driver lost")
        replace(spark, rows, store, name, days)

    with monkeypatch.context() as m:
        m.setattr(changes, "_replace_days", lost)
        with pytest.raises(RuntimeError, match="lost"):
            update_changes(spark, store, store, "a26", ["2024-01-01"])
    assert update_changes(spark, store, store, "a26", ["2024-01-01"]) == ["2024-01-01", "2024-01-04"]
    compare(spark, store)


def test_only_touched_partitions_are_read(spark):
    store = TableStore(scratch_path(spark, "store"))
    write_snapshot(taken(spark, *[("a", "RS", f"2024-01-{d:02d}T10:00:00Z", d) for d in range(1, 20)]), store, "channels")
    rows = snapshots_of(spark, store, "channels", ["2024-01-05", "2024-01-07"])
    assert len(rows.inputFiles()) == 19 and "PartitionFilters: [" in rows._jdf.queryExecution().executedPlan().toString()
    scanned = rows.select(F.input_file_name().alias("f")).distinct().collect()
    assert sorted(r.f.split("snapshot_date=")[1][:10] for r in scanned) == ["2024-01-05", "2024-01-07"]
    with pytest.raises(ValueError, match="daily changes"):
        update_changes(spark, store, store, "a01", ["2024-01-05"])
    assert REPORTS["a26"].entity == "channels"
