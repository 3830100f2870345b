import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from metricloom import session
from metricloom.operators.quality import quality_counts, sample_rows
from metricloom.plans.enrich import run_enrich_comments, run_enrich_playlists, run_enrich_videos
from metricloom.sources.tables import TableStore, jdbc_options, read_table, write_snapshot, write_table

URL = "jdbc:postgresql://db.example/batch"


def test_an_existing_table_is_an_error(spark, tmp_path):
    store = TableStore(str(tmp_path))
    write_table(spark.range(3), store, "t")
    with pytest.raises(AnalysisException):
        write_table(spark.range(3), store, "t")
    write_table(spark.range(2), store, "t", mode="append")
    assert read_table(spark, store, "t").count() == 5


def test_snapshot_days_replace_only_themselves(spark, tmp_path):
    store = TableStore(str(tmp_path))
    for day, rows in (("2024-01-01", 3), ("2024-01-02", 4), ("2024-01-01", 5)):
        write_snapshot(spark.range(rows), store, "s", day)
    counts = read_table(spark, store, "s").groupBy("snapshot_date").count().collect()
    assert {str(r[0]): r[1] for r in counts} == {"2024-01-01": 5, "2024-01-02": 4}


def test_a_day_reads_only_its_partition(spark, tmp_path):
    store = TableStore(str(tmp_path))
    write_snapshot(spark.range(3), store, "s", "2024-01-01")
    day = read_table(spark, store, "s").where("snapshot_date = date'2024-01-01'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_snapshots_are_not_written_to_a_database(spark):
    with pytest.raises(ValueError):
        write_snapshot(spark.range(1), TableStore(URL), "s", "2024-01-01")


def test_jdbc_options():
    split = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    store = TableStore(URL, {"driver": "d", "user": "u", **split})
    read = jdbc_options(store, "public.videos")
    assert read["url"] == URL and read["dbtable"] == "public.videos" and read["fetchsize"] == "10000"
    assert split.items() <= read.items()
    written = jdbc_options(store, "public.videos", writing=True)
    assert [o for o in split if o in written] == ["numPartitions"] and written["user"] == "u" and written["batchsize"] == "10000"


@pytest.mark.parametrize("left_out", ["lowerBound", "upperBound", "numPartitions"])
def test_half_a_parallel_read_is_refused(left_out):
    split = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    del split[left_out]
    with pytest.raises(ValueError):
        jdbc_options(TableStore(URL, split), "t")


def test_enrich_tables(spark, tmp_path):
    store = TableStore(str(tmp_path))
    write_table(spark.sql("SELECT 'p1' AS playlist_id, 'one two' AS playlist_title"), store, "playlists")
    write_table(spark.sql("SELECT 'v1' AS video_id, 'on @Reddit!' AS video_description"), store, "videos")
    write_table(spark.sql("SELECT 'c1' AS comment_id, CAST(NULL AS STRING) AS comment_text"), store, "comments")
    run_enrich_playlists(spark, store, store)
    run_enrich_videos(spark, store, store)
    run_enrich_comments(spark, store, store)
    assert read_table(spark, store, "playlists_enriched").first().playlist_title_length == 2
    video = read_table(spark, store, "videos_enriched").first()
    assert (video.reddit_count, video.discord_count) == (1, 0)
    assert read_table(spark, store, "comments_enriched").first().text_length is None
    with pytest.raises(AnalysisException):
        run_enrich_videos(spark, store, store)


def test_quality_counts_and_sample(spark):
    rows = spark.range(100).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("key"))
    assert tuple(quality_counts(rows, "key").first()) == (100, 10)
    assert [r.key for r in sample_rows(rows.dropna(), "key", 3).collect()] == [1, 2, 3]
    assert quality_counts(rows.limit(0), "key").first().row_count == 0


def test_scratch_lies_in_the_named_folder(spark):
    first, second = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get(session.CHECKPOINT_DIR))


class _Session:
    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(RuntimeError):
        session.shared_folder(_Session("spark://host:7077"))
    named = _Session("yarn", **{session.CHECKPOINT_DIR: "hdfs:///shared/"})
    assert session.shared_folder(named) == "hdfs:///shared"
    local = session.shared_folder(_Session("local[2]"))
    assert os.path.isdir(local) and session.shared_folder(_Session("local[2]")) == local


def test_materialize_keeps_rows_and_ends_lineage(spark):
    rows = spark.range(10).selectExpr("id", "id % 3 AS k").groupBy("k").count()
    written = session.materialize(rows, "groups")
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, rows.collect()))
    assert "Aggregate" not in written._jdf.queryExecution().optimizedPlan().toString()


def test_days_are_written_in_few_files(spark, tmp_path):
    store = TableStore(str(tmp_path))
    rows = spark.range(0, 3000, 1, 16).selectExpr("id", "date_add(date'2024-01-01', CAST(id % 3 AS INT)) AS snapshot_date")
    write_snapshot(rows, store, "s")
    assert len(read_table(spark, store, "s").inputFiles()) <= 6
    assert read_table(spark, store, "s").count() == 3000


def test_job_settings_give_way_to_the_submit(spark):
    try:
        assert session.job_session("job") is not None
        assert spark.conf.get("spark.sql.files.openCostInBytes") == "512k"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    finally:
        for key in session.JOB_CONF:
            spark.conf.unset(key)
