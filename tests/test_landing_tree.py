import json
import os

import pytest
from pyspark.sql import functions as F

from metricloom.operators.envelope import flatten_envelope, nested_item
from metricloom.plans.cleanse import LANDING_GLOBS, run_cleanse
from metricloom.sources.landing_tree import TREES, folder_name, key_of_folder, land_tree, read_tree
from metricloom.sources.tables import TableStore, read_table

KEYS = ["plain", "_hidden", ".dots", "a/b c", "100%", "*?[{", "ü+é", "=x", "", None, "%41", "-x_y"]


def rows(spark, keys, copies=3):
    data = [(f"v{i}-{n}", key, f"c{i % 2}") for i, key in enumerate(keys) for n in range(copies)]
    return spark.createDataFrame(data, "video_id string, channel_id string, other string")


def land(df, path, page_bytes=1 << 20, rows_per_task=250_000):
    keys = {"channel_id": F.col("channel_id"), "video_id": F.col("other")}
    return land_tree(df, path, "videos", keys, nested_item(df.drop("other"), "videos"), "video_id", page_bytes, rows_per_task)


def test_folder_names_come_back(column):
    names = column(KEYS, "string", folder_name(F.col("c")))
    assert all(n and "/" not in n and n[0] not in "._" for n in names) and len(set(names)) == len(KEYS)
    assert column(KEYS, "string", key_of_folder(folder_name(F.col("c")))) == KEYS
    assert column(["50%zz", "a%2Fb"], "string", key_of_folder(F.col("c"))) == ["50%zz", "a/b"]


def test_keys_are_read_back_from_the_folders(spark, tmp_path):
    df, path = rows(spark, KEYS), str(tmp_path / "landing")
    written = land(df, path).collect()
    assert len(written) == len(KEYS) and all((r.pages, r.items) == (1, 3) for r in written)
    read = read_tree(spark, path, "videos").select("folder_channel_id", "folder_video_id", F.explode("items.id").alias("id")).collect()
    assert sorted(map(str, ((r.id, r.folder_channel_id, r.folder_video_id) for r in read))) == sorted(map(str, ((r.video_id, r.channel_id, r.other) for r in df.collect())))
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names]
    assert all(len(json.loads(open(f).read())["items"]) == 3 for f in files if f.endswith(".json"))


def test_globs_of_the_cleansing_jobs_read_the_tree(spark, tmp_path):
    df, path, store = rows(spark, KEYS), str(tmp_path / "landing"), TableStore(str(tmp_path / "tables"))
    land(df, path)
    counts = run_cleanse(spark, "videos", f"{path}/{LANDING_GLOBS['videos']}", store, "videos")
    assert counts["row_count"] == df.count() and counts["broken_document_count"] == 0
    assert sorted(r.video_id for r in read_table(spark, store, "videos").collect()) == sorted(r.video_id for r in df.collect())


def test_landing_again_leaves_no_old_pages(spark, tmp_path):
    path = str(tmp_path / "landing")
    many = land(rows(spark, ["hot", "cold"], 40), path, page_bytes=100, rows_per_task=10).collect()
    assert min(r.pages for r in many) > 5
    few = rows(spark, ["hot"], 2)
    assert [(r.pages, r.items) for r in land(few, path).collect()] == [(1, 2)]
    ids = flatten_envelope(read_tree(spark, path, "videos").where("folder_channel_id = 'hot'"), "videos")
    assert sorted(r.video_id for r in ids.collect()) == ["v0-0", "v0-1"]


def test_single_files_and_unfinished_ones(spark, tmp_path):
    """A crawl leaves one file in the place of the folder; a lost task leaves a file under its attempt's name."""
    for video in ("v1", "v%202"):
        folder = tmp_path / "channels" / "c1" / "videos" / video
        folder.mkdir(parents=True)
        (folder / "statistics").write_text(json.dumps({"items": [{"id": video}]}))
    land(rows(spark, ["c2"], 1), str(tmp_path))
    (tmp_path / "channels" / "c2" / "videos" / "c0" / "statistics" / ".7-page-000001.json").write_text('{"items": [{"id": "lost"}')
    read = read_tree(spark, str(tmp_path), "videos").collect()
    assert sorted((r.folder_channel_id, r.folder_video_id, r["items"][0].id) for r in read) == [("c1", "v 2", "v%202"), ("c1", "v1", "v1"), ("c2", "c0", "v0-0")]


def test_trees_and_globs_agree():
    for entity, tree in TREES.items():
        glob = "/".join("*" if level.startswith("{") else level for level in tree.split("/"))
        assert LANDING_GLOBS[entity] in (glob, f"{glob}/*")


def test_every_level_needs_a_key(spark, tmp_path):
    with pytest.raises(ValueError, match="video_id"):
        land_tree(rows(spark, ["a"]), str(tmp_path), "comments", {"channel_id": F.col("channel_id")}, F.struct("video_id"), "video_id")
