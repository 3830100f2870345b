import json
import os
import subprocess
import sys

import pytest

from metricloom.jobs import PASSWORD, arguments, main, store
from metricloom.sources.tables import TableStore, read_table


def test_batch_jobs_end_to_end(spark, tmp_path, capsys):
    landing = tmp_path / "landing"
    landing.mkdir()
    comment = {"textDisplay": "one two", "authorDisplayName": "A", "likeCount": 4, "publishedAt": "2020-03-08T10:30:00Z"}
    item = {"id": "x", "snippet": {"videoId": "v", "topLevelComment": {"snippet": comment}}}
    (landing / "content").write_text(json.dumps({"items": [item, {**item, "id": "y"}]}))
    tables = ["--tables", str(tmp_path / "tables")]
    main(["cleanse", "comments", "--landing", str(landing), *tables], spark)
    assert "'row_count': 2" in capsys.readouterr().out
    main(["enrich", "comments", *tables], spark)
    main(["report", "a25", "--table", "comments_enriched", "--target", "authors", *tables], spark)
    authors = read_table(spark, TableStore(str(tmp_path / "tables")), "authors").collect()
    assert [tuple(r) for r in authors] == [("A", 2, 8, 2.0)]


def test_streaming_job(spark, tmp_path):
    spark.sql("""SELECT CAST(NULL AS STRING) AS key, CAST('{"channel_id":"c","published_at":"0"}' AS BINARY) AS value""").write.parquet(
        str(tmp_path / "topic")
    )
    main(
        ["dated", "channels", "--topic", str(tmp_path / "topic"), "--tables", str(tmp_path / "tables"), "--checkpoint", str(tmp_path / "ck")],
        spark,
    )
    row = read_table(spark, TableStore(str(tmp_path / "tables")), "channels_year_month").first()
    assert (row.channel_id, row.year, row.month) == ("c", "1970", "January")


def test_snapshot_job_fills_a_table_that_is_reported(spark, tmp_path):
    spark.sql("""SELECT CAST(NULL AS STRING) AS key,
                 CAST('{"id":"c","snippet":{"country":"RS"},"statistics":{"viewCount":"5"}}' AS BINARY) AS value""").write.parquet(
        str(tmp_path / "topic")
    )
    tables = ["--tables", str(tmp_path / "tables")]
    main(["snapshot", "channels", "--topic", str(tmp_path / "topic"), *tables, "--checkpoint", str(tmp_path / "ck")], spark)
    main(["report", "a26", "--table", "channels_snapshots", "--target", "changes", *tables], spark)
    row = read_table(spark, TableStore(str(tmp_path / "tables")), "changes").first()
    assert (row.country, row.view_count_sum, row.percent_change) == ("RS", 5, None)


def test_a_stream_has_one_sink():
    both = ["snapshot", "videos", "--topic", "t", "--to", "u", "--tables", "/t", "--checkpoint", "/c"]
    with pytest.raises(SystemExit):
        arguments(both)
    assert arguments(both[:4] + both[6:]).tables == "/t"


@pytest.mark.parametrize("job", ["consume", "snapshot", "dated"])
def test_streams_need_a_sink_or_preview(job):
    with pytest.raises(SystemExit):
        arguments([job, "videos", "--topic", "t"])
    assert arguments([job, "videos", "--topic", "t", "--preview"]).preview


def test_password_comes_from_the_environment(monkeypatch):
    args = arguments(["enrich", "videos", "--tables", "jdbc:postgresql://db/batch", "--jdbc", "user=reports"])
    monkeypatch.setenv(PASSWORD, "secret")
    assert store(args).options == {"user": "reports", "password": "secret"}
    folder = arguments(["enrich", "videos", "--tables", "/tables"])
    assert store(folder).options == {}


def test_the_launcher_starts_from_any_folder(tmp_path):
    launcher = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "metricloom_job.py")
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, launcher, "--help"], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "fanout" in done.stdout


def test_land_cleanse_and_fan_out(spark, tmp_path):
    rows = [("p1", "T", None, None, "c1", "C", 3), ("p2", "T", None, None, "c1", "C", 4), ("p3", "T", None, None, "c2", "D", 5)]
    schema = "playlist_id string, playlist_title string, playlist_description string, published_at timestamp, channel_id string, channel_title string, videos_count int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/tables/playlists")
    main(["land", "playlists", "--tables", f"{tmp_path}/tables", "--landing", f"{tmp_path}/landing", "--key", "channel_id", "--order-by", "playlist_id"], spark)
    main(["cleanse", "playlists", "--tables", f"{tmp_path}/tables", "--landing", f"{tmp_path}/landing", "--table", "back"], spark)
    back = spark.read.parquet(f"{tmp_path}/tables/back")
    assert sorted(r.playlist_id for r in back.collect()) == ["p1", "p2", "p3"]
    main(["fanout", "--tables", f"{tmp_path}/tables", "--table", "back", "--key", "channel_id", "--target", "channel_ids"], spark)
    for _ in range(2):
        main(["fanout", "--tables", f"{tmp_path}/tables", "--table", "back", "--key", "channel_id", "--target", "new_ids", "--checkpoint", f"{tmp_path}/fanout"], spark)
    assert sorted(r.channel_id for r in spark.read.parquet(f"{tmp_path}/tables/channel_ids").collect()) == ["c1", "c2"]
    assert sorted(r.channel_id for r in spark.read.parquet(f"{tmp_path}/tables/new_ids").collect()) == ["c1", "c2"]


def test_compact_a_table_of_batches(spark, tmp_path, capsys):
    from metricloom.streaming.compaction import read_compacted

    for batch in range(3):
        spark.range(batch, batch + 1).write.parquet(f"{tmp_path}/t/query_id=q/batch_id={batch}")
    main(["compact", "--tables", str(tmp_path), "--table", "t", "--target-mb", "1", "--keep", "1"], spark)
    assert "upto={'q': 1}" in capsys.readouterr().out
    assert sorted(r.id for r in read_compacted(spark, f"{tmp_path}/t").collect()) == [0, 1, 2]
