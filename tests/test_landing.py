import glob
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from metricloom.operators.envelope import flatten_envelope, nested_item
from metricloom.operators.pages import hot_keys, paged_items, to_envelopes
from metricloom.plans.cleanse import LANDING_GLOBS, run_cleanse_videos
from metricloom.session import scratch_path
from metricloom.sources.landing import broken_documents, fanout_keys, land_by_key, read_documents, read_envelopes
from metricloom.sources.tables import TableStore, read_table


@pytest.fixture
def playlists(spark):
    """1,000 rows: one key holds half of them, 100 copies of one row, and a missing key."""
    return spark.range(1000).select(
        F.when(F.col("id") < 100, "copy").otherwise(F.col("id").cast("string")).alias("playlist_id"),
        F.when(F.col("id") < 500, "hot").when(F.col("id") < 520, None).otherwise(F.concat(F.lit("k/ey "), F.col("id") % 40)).alias("channel_id"),
        F.lit("a title").alias("playlist_title"),
        F.lit(3).alias("videos_count"),
    )


def land(df, path, **options):
    rows = df.select(F.col("channel_id").alias("folder"), "playlist_id", nested_item(df, "playlists").alias("item"))
    land_by_key(rows, path, "folder", F.col("item"), "playlist_id", **options)


def ids(df):
    return Counter((r.playlist_id, r.channel_id) for r in df.select("playlist_id", "channel_id").collect())


def test_round_trip_with_hot_keys_and_copies(spark, playlists):
    path = scratch_path(spark, "landing")
    land(playlists, path, page_bytes=900, rows_per_task=60)
    back = flatten_envelope(read_envelopes(spark, path, "playlists"), "playlists")
    assert ids(back) == ids(playlists)
    files = glob.glob(f"{path}/*/*.json")
    documents = [json.loads(open(f).read()) for f in files]  # exactly one document in each file
    assert all(d["pageInfo"]["resultsPerPage"] == len(d["items"]) >= 1 for d in documents)
    sizes = [sum(len(json.dumps(i, separators=(",", ":"))) for i in d["items"]) for d in documents]
    assert max(sizes) < 900 + 200 and sum(len(d["items"]) > 1 for d in documents) > 100
    for f, d in zip(files, documents):
        assert len({i["snippet"].get("channelId") for i in d["items"]}) == 1, f


def test_lines_in_one_file_would_be_lost(spark, playlists):
    """Why one document per file matters: a reader of whole documents stops after the first."""
    path = scratch_path(spark, "lines")
    to_envelopes(playlists, "channel_id", nested_item(playlists, "playlists"), "playlist_id", 900).coalesce(1).write.json(path)
    assert sum(ids(flatten_envelope(read_envelopes(spark, path, "playlists"), "playlists")).values()) < 1000


def test_a_glob_reads_the_same(spark, playlists):
    path = scratch_path(spark, "landing")
    land(playlists, path)
    assert read_envelopes(spark, f"{path}/*/*", "playlists").count() == read_envelopes(spark, path, "playlists").count()


def places(df, **options):
    paged = paged_items(df, "channel_id", nested_item(df, "playlists"), "playlist_id", page_bytes=900, **options)
    return Counter((r.page_key, r.page, r.position, r.item.id, r.key_rows) for r in paged.collect())


def test_pages_do_not_depend_on_splitting(spark, playlists):
    whole = places(playlists)
    assert places(playlists.repartition(8), rows_per_task=60) == whole
    by_key = {}
    for key, page, position, playlist_id, key_rows in sorted(whole, key=lambda p: (str(p[0]), p[2])):
        by_key.setdefault(key, []).append((page, position, playlist_id))
        assert key_rows == {"hot": 500, None: 20}.get(key, 12)
    for rows in by_key.values():
        assert [r[1] for r in rows] == list(range(len(rows)))
        assert [r[2] for r in rows] == sorted(r[2] for r in rows) and [r[0] for r in rows] == sorted(r[0] for r in rows)


def test_pages_point_to_the_next(spark, playlists):
    documents = to_envelopes(playlists, "channel_id", nested_item(playlists, "playlists"), "playlist_id", 900, 60).collect()
    by_key = {}
    for d in sorted(documents, key=lambda d: d.pageInfo.firstItem):
        by_key.setdefault(d.channel_id, []).append(d)
    for pages in by_key.values():
        assert [p.nextPageToken for p in pages] == [*(str(p.pageInfo.firstItem) for p in pages[1:]), None]
    assert len(by_key["hot"]) > 50


def test_many_pages_in_a_task_stay_in_order(spark):
    rows = spark.range(60_000).select((F.col("id") % 2000).cast("string").alias("k"), F.lpad(F.col("id").cast("string"), 6, "0").alias("o"))
    documents = to_envelopes(rows.repartition(2), "k", F.struct("o"), "o", 120).collect()
    assert sum(len(d["items"]) for d in documents) == 60_000 and len(documents) > 2000
    assert all([i.o for i in d["items"]] == sorted(i.o for i in d["items"]) for d in documents)


def test_hot_keys_beyond_the_broadcast_size(spark, playlists):
    expected = places(playlists)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert places(playlists.repartition(8), rows_per_task=60) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_missing_key_can_be_hot(spark, playlists):
    missing = playlists.withColumn("channel_id", F.lit(None).cast("string"))
    assert [r.hot_key for r in hot_keys(missing, "channel_id", 100).collect()] == [None]
    assert places(missing, rows_per_task=100) == places(missing)


def test_one_shuffle_per_landing(spark, playlists):
    documents = to_envelopes(playlists, "channel_id", nested_item(playlists, "playlists"), "playlist_id")
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan and "Python" not in plan


def test_broken_documents(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"items": [{"id": "p1"}]}')
    (tmp_path / "bad.json").write_text('{"items": [{"id": "p2"')
    (tmp_path / "none.json").write_text('{"etag": "x"}')
    rows = flatten_envelope(read_envelopes(spark, str(tmp_path), "playlists"), "playlists").collect()
    assert [r.playlist_id for r in rows] == ["p1"]
    assert read_documents(spark, str(tmp_path), "playlists").count() == 3
    broken = broken_documents(spark, str(tmp_path), "playlists").collect()
    assert [r.file.rsplit("/", 1)[1] for r in broken] == ["bad.json"]


def test_cleanse_the_landing_tree(spark, tmp_path):
    """A tree as the crawl leaves it: indented documents with fields that are not kept."""
    item = {
        "id": "v1",
        "kind": "item",
        "etag": "x",
        "snippet": {"title": "T", "channelId": "c1", "categoryId": "10", "publishedAt": "2020-03-08T10:30:00Z", "tags": ["a"]},
        "contentDetails": {"duration": "PT1M"},
        "statistics": {"viewCount": "7", "likeCount": "x"},
        "status": {"madeForKids": False},
    }
    for video, document in {"v1": [item], "v2": [{**item, "id": "v2", "snippet": {"categoryId": "3"}}, {"snippet": {}}], "v3": []}.items():
        folder = tmp_path / "landing" / "channels" / "c1" / "videos" / video
        folder.mkdir(parents=True)
        (folder / "statistics").write_text(json.dumps({"kind": "list", "items": document}, indent=2))
        (folder / "content").write_text('{"items": []}')
    store = TableStore(str(tmp_path / "tables"))
    counts = run_cleanse_videos(spark, f"{tmp_path}/landing/{LANDING_GLOBS['videos']}", store)
    assert counts == {"document_count": 3, "broken_document_count": 0, "row_count": 3, "null_key_count": 1}
    rows = {r.video_id: r.asDict() for r in read_table(spark, store, "videos").drop("published_at").collect()}
    assert rows["v1"] == {
        "video_id": "v1",
        "channel_id": "c1",
        "channel_title": None,
        "video_title": "T",
        "video_description": None,
        "view_count": 7,
        "like_count": None,
        "comment_count": None,
        "category_id": 10,
        "category": "Music",
        "language": None,
        "made_for_kids": False,
    }
    assert rows["v2"]["category_id"] == 3 and rows["v2"]["category"] is None


def test_cleanse_counts_broken_documents(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"items": [{"id": "v1"}, {"id": "v2"}]}')
    (tmp_path / "bad.json").write_text('{"items": [{"id": "v3"')
    counts = run_cleanse_videos(spark, str(tmp_path), TableStore(str(tmp_path / "tables")))
    assert (counts["document_count"], counts["broken_document_count"], counts["row_count"]) == (2, 1, 2)


def test_fanout_keys(spark):
    rows = spark.createDataFrame([("c1", "v1"), ("c1", "v1"), ("c1", None), ("c2", "v1"), (None, "v2")], "c string, v string")
    assert sorted(r.v for r in fanout_keys(rows, "v").collect()) == ["v1", "v2"]
    assert {tuple(r) for r in fanout_keys(rows, "v", "c").collect()} == {("c1", "v1"), ("c2", "v1"), (None, "v2")}
