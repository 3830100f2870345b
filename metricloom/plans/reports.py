"""The reports: grouped sums, counts, averages, shares and daily changes.

A report names its groups and measures; Spark pre-aggregates before each shuffle, so a
group that holds most of the rows costs no more than any other. Inputs are the cleansed,
enriched, dated and snapshot tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricloom.operators.snapshots import daily_change
from metricloom.plans.dated import with_publish_period
from metricloom.session import materialize

AUTHOR = "comment_author_channel_name"


@dataclass(frozen=True)
class Report:
    entity: str
    title: str
    groups: tuple[str, ...]
    measures: Mapping[str, Callable[[], Column]] = field(default_factory=dict)

    def build(self, df: DataFrame) -> DataFrame:
        measures = [make().alias(name) for name, make in self.measures.items()]
        return df.groupBy(*self.groups).agg(*measures)

    def finish(self, grouped: DataFrame) -> DataFrame:
        """What is still to do with the grouped measures."""
        return grouped


@dataclass(frozen=True)
class Listing(Report):
    """The columns as they are, one row per row of the table."""

    def build(self, df: DataFrame) -> DataFrame:
        return df.select(*self.groups)


@dataclass(frozen=True)
class Share(Report):
    """Each measure with its percentage of the total over all groups.

    The grouped rows are written once and read for both the shares and their one-row total, so
    the table is scanned once and neither it nor the groups pass through a single task.
    """

    percentages: tuple[str, ...] = ()

    def build(self, df: DataFrame) -> DataFrame:
        return self.finish(materialize(super().build(df), "grouped"))

    def finish(self, grouped: DataFrame) -> DataFrame:
        shares = []
        for name in self.percentages:
            total = grouped.agg(F.sum(name)).scalar()
            share = F.col(name) * 100 / F.nullif(total, F.lit(0))
            shares.append(share.alias(f"{name}_percent"))
        return grouped.select("*", *shares)


@dataclass(frozen=True)
class Change(Report):
    """Daily sums of a measure with their percent change from day to day."""

    key: str = ""
    measure: str = ""

    def build(self, df: DataFrame) -> DataFrame:
        return daily_change(df, self.key, self.groups, self.measure)


def _sum(column: str) -> dict[str, Callable[[], Column]]:
    return {f"{column}_sum": lambda: F.sum(column)}


def _avg(column: str) -> dict[str, Callable[[], Column]]:
    return {f"{column}_avg": lambda: F.avg(column)}


def _count(name: str) -> dict[str, Callable[[], Column]]:
    return {name: lambda: F.count(F.lit(1))}


REPORTS: dict[str, Report] = {
    "a01": Report("channels", "view sums per country", ("country",), _sum("view_count")),
    "a02": Report("channels", "video sums per country", ("country",), _sum("video_count")),
    "a03": Report("channels", "subscriber sums per country and year", ("country", "year"), _sum("subscriber_count")),
    "a04": Report("channels", "channels with view sums", ("channel_id", "channel_title"), _sum("view_count")),
    "a05": Report("channels", "channels per publish year", ("year",), _count("channel_count")),
    "a06": Report("channels", "channels per publish month", ("month",), _count("channel_count")),
    "a07": Report("playlists", "playlist titles per number of videos", ("playlist_title",), _sum("videos_count")),
    "a08": Report(
        "playlists",
        "playlist titles per title length and year",
        ("year", "playlist_title_length"),
        _count("playlist_count"),
    ),
    "a09": Report("playlists", "playlists per year and month", ("year", "month"), _count("playlist_count")),
    "a10": Report("videos", "view sums per video and channel title", ("video_title", "channel_title"), _sum("view_count")),
    "a11": Listing("videos", "views per video and channel title", ("video_title", "channel_title", "view_count")),
    "a12": Report("videos", "videos per category", ("category",), _count("video_count")),
    "a13": Report("videos", "videos per 'Instagram' mentions", ("instagram_count",), _count("video_count")),
    "a14": Report("videos", "videos per 'Twitter' mentions", ("twitter_count",), _count("video_count")),
    "a15": Share(
        "videos",
        "video count and like sum percentages per language",
        ("language",),
        _count("video_count") | _sum("like_count"),
        ("video_count", "like_count_sum"),
    ),
    "a16": Report("videos", "videos per year and month", ("year", "month"), _count("video_count")),
    "a17": Report(
        "videos",
        "videos with sums of views, likes and durations",
        ("video_id", "video_title"),
        _sum("view_count") | _sum("like_count") | _sum("duration_seconds"),
    ),
    "a18": Report("videos", "duration sums per category", ("category",), _sum("duration_seconds")),
    "a19": Report("videos", "videos per category and language", ("category", "language"), _count("video_count")),
    "a20": Report("videos", "average duration per category and language", ("category", "language"), _avg("duration_seconds")),
    "a21": Report("comments", "comments per author", (AUTHOR,), _count("comment_count")),
    "a22": Report("comments", "average text length per author", (AUTHOR,), _avg("text_length")),
    "a23": Report("comments", "like sums per author", (AUTHOR,), _sum("comment_like_count")),
    "a24": Report("comments", "comments per year and month", ("year", "month"), _count("comment_count")),
    "a25": Report(
        "comments",
        "authors in relation to likes and text lengths",
        (AUTHOR,),
        _count("comment_count") | _sum("comment_like_count") | _avg("text_length"),
    ),
    "a26": Change(
        "channels", "view sums per country with percent change", ("country",), key="channel_id", measure="view_count"
    ),
    "a27": Change(
        "playlists",
        "videos per playlist and channel title with percent change",
        ("playlist_title", "channel_title"),
        key="playlist_id",
        measure="videos_count",
    ),
    "a28": Change(
        "videos",
        "like sums per video and channel title with percent change",
        ("video_title", "channel_title"),
        key="video_id",
        measure="like_count",
    ),
}


def report(name: str, df: DataFrame, **columns: str) -> DataFrame:
    """Report ``name`` over a table. ``columns`` maps the report's columns to the table's
    where they differ: ``report("a21", df, comment_author_channel_name="author")``. A table
    without year and month gets them from ``published_at``."""
    spec = REPORTS[name]
    renamed = df.withColumnsRenamed({actual: expected for expected, actual in columns.items()})
    if {"year", "month"} & set(spec.groups) and not {"year", "month"} & set(renamed.columns):
        renamed = with_publish_period(renamed)
    return spec.build(renamed)
