"""Declared fields of the four entities.

One list of ``Field`` per entity describes where a column sits in an API item, how it
arrives there and what it becomes in the table; the nested schema, the projection and
its inverse all derive from it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str  # column in the table
    path: str  # dotted path inside an API item
    arrives: str = "string"  # type in the JSON item
    becomes: str = "string"  # type in the table


# Item paths and table columns of each entity.
ITEM_FIELDS: dict[str, tuple[Field, ...]] = {
    "channels": (
        Field("channel_id", "id"),
        Field("channel_title", "snippet.title"),
        Field("channel_description", "snippet.description"),
        Field("published_at", "snippet.publishedAt", becomes="timestamp"),
        Field("country", "snippet.country"),
        Field("subscriber_count", "statistics.subscriberCount", becomes="bigint"),
        Field("video_count", "statistics.videoCount", becomes="int"),
        Field("view_count", "statistics.viewCount", becomes="bigint"),
    ),
    "playlists": (
        Field("playlist_id", "id"),
        Field("playlist_title", "snippet.title"),
        Field("playlist_description", "snippet.description"),
        Field("published_at", "snippet.publishedAt", becomes="timestamp"),
        Field("channel_id", "snippet.channelId"),
        Field("channel_title", "snippet.channelTitle"),
        Field("videos_count", "contentDetails.itemCount", arrives="int", becomes="int"),
    ),
    "videos": (
        Field("video_id", "id"),
        Field("published_at", "snippet.publishedAt", becomes="timestamp"),
        Field("channel_id", "snippet.channelId"),
        Field("channel_title", "snippet.channelTitle"),
        Field("video_title", "snippet.title"),
        Field("video_description", "snippet.description"),
        Field("view_count", "statistics.viewCount", becomes="bigint"),
        Field("like_count", "statistics.likeCount", becomes="int"),
        Field("comment_count", "statistics.commentCount", becomes="int"),
        Field("category_id", "snippet.categoryId", becomes="int"),
        Field("language", "snippet.defaultAudioLanguage"),
        Field("duration", "contentDetails.duration"),
        Field("made_for_kids", "status.madeForKids", arrives="boolean", becomes="boolean"),
    ),
    "comments": (
        Field("comment_id", "id"),
        Field("video_id", "snippet.videoId"),
        Field("comment_text", "snippet.topLevelComment.snippet.textDisplay"),
        Field("comment_author_channel_name", "snippet.topLevelComment.snippet.authorDisplayName"),
        Field("comment_author_channel_id", "snippet.topLevelComment.snippet.authorChannelId.value"),
        Field("comment_author_channel_url", "snippet.topLevelComment.snippet.authorChannelUrl"),
        Field("comment_like_count", "snippet.topLevelComment.snippet.likeCount", arrives="int", becomes="int"),
        Field("published_at", "snippet.topLevelComment.snippet.publishedAt", becomes="timestamp"),
        Field("total_reply_count", "snippet.totalReplyCount", arrives="int", becomes="int"),
    ),
}
ENTITIES = tuple(ITEM_FIELDS)
KEYS = {
    "channels": "channel_id",
    "playlists": "playlist_id",
    "videos": "video_id",
    "comments": "comment_id",
}

# Columns of the cleansed tables, in order.
TABLE_COLUMNS: dict[str, tuple[str, ...]] = {
    "channels": (
        "channel_id",
        "channel_title",
        "channel_description",
        "published_at",
        "country",
        "subscriber_count",
        "video_count",
        "view_count",
    ),
    "playlists": (
        "playlist_id",
        "playlist_title",
        "playlist_description",
        "published_at",
        "channel_id",
        "channel_title",
        "videos_count",
    ),
    "videos": (
        "video_id",
        "published_at",
        "channel_id",
        "channel_title",
        "video_title",
        "video_description",
        "view_count",
        "like_count",
        "comment_count",
        "category_id",
        "category",
        "language",
        "made_for_kids",
    ),
    "comments": (
        "comment_id",
        "video_id",
        "comment_text",
        "comment_author_channel_name",
        "comment_author_channel_id",
        "comment_author_channel_url",
        "comment_like_count",
        "published_at",
        "total_reply_count",
    ),
}

# Columns of the snapshot messages after current_time, in order (before the
# text length of playlists and comments).
SNAPSHOT_COLUMNS: dict[str, tuple[str, ...]] = {
    "channels": TABLE_COLUMNS["channels"],
    "playlists": TABLE_COLUMNS["playlists"],
    "videos": (
        "video_id",
        "video_title",
        "video_description",
        "published_at",
        "channel_id",
        "channel_title",
        "category_id",
        "category",
        "language",
        "duration",
        "view_count",
        "like_count",
        "comment_count",
    ),
    "comments": (
        "comment_id",
        "video_id",
        "comment_text",
        "comment_author_channel_name",
        "comment_author_channel_id",
        "comment_author_channel_url",
        "published_at",
        "comment_like_count",
        "total_reply_count",
    ),
}

# Flat messages read by the consumers.
CONSUMER_MESSAGES: dict[str, dict[str, str]] = {
    "channels": {
        "channel_id": "string",
        "subscriber_count": "bigint",
        "video_count": "int",
        "view_count": "bigint",
    },
    "playlists": {
        "playlist_id": "string",
        "playlist_title": "string",
        "playlist_description": "string",
        "published_at": "timestamp",
        "channel_id": "string",
        "channel_title": "string",
        "videos_count": "int",
    },
    "videos": {
        "video_id": "string",
        "published_at": "timestamp",
        "channel_id": "string",
        "channel_title": "string",
        "video_title": "string",
        "video_description": "string",
        "view_count": "bigint",
        "like_count": "int",
        "comment_count": "int",
        "category_id": "int",
        "category": "string",
        "language": "string",
    },
    "comments": {
        "comment_id": "string",
        "video_id": "string",
        "comment_text": "string",
        "comment_author_channel_name": "string",
        "comment_author_channel_id": "string",
        "comment_like_count": "int",
        "published_at_timestamp": "timestamp",
        "total_reply_count": "int",
    },
}

# Flat messages with epoch-millis publish times, read for year and month.
DATED_MESSAGES: dict[str, dict[str, str]] = {
    "channels": {
        "channel_id": "string",
        "channel_title": "string",
        "channel_description": "string",
        "published_at": "string",
        "country": "string",
        "subscriber_count": "bigint",
        "video_count": "int",
        "view_count": "bigint",
    },
    "playlists": {
        "playlist_id": "string",
        "playlist_title": "string",
        "playlist_description": "string",
        "published_at": "string",
        "channel_id": "string",
        "channel_title": "string",
        "videos_count": "int",
        "playlist_title_length": "int",
    },
    "videos": {
        "video_id": "string",
        "video_title": "string",
        "video_description": "string",
        "published_at": "string",
        "channel_id": "string",
        "channel_title": "string",
        "category_id": "int",
        "category": "string",
        "language": "string",
        "duration": "string",
        "view_count": "double",
        "like_count": "int",
        "comment_count": "int",
    },
    "comments": {
        "comment_id": "string",
        "video_id": "string",
        "comment_text": "string",
        "comment_author_channel_name": "string",
        "comment_author_channel_id": "string",
        "comment_author_channel_url": "string",
        "published_at": "string",
        "comment_like_count": "int",
        "total_reply_count": "int",
        "text_length": "int",
    },
}

# Columns that are renamed when a flat message is read.
CONSUMER_RENAMES = {"comments": {"published_at_timestamp": "published_at"}}
DATED_RENAMES = {"comments": {"comment_author_channel_name": "comment_author_channel_title"}}

CORRUPT = "_corrupt_record"


TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def struct_of(columns: Mapping[str, str]) -> T.StructType:
    """Struct type of a flat message: column name to type name."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns.items()])


def _nest(fields: list[tuple[list[str], str]]) -> T.StructType:
    groups: dict[str, list[tuple[list[str], str]]] = {}
    for path, kind in fields:
        groups.setdefault(path[0], []).append((path[1:], kind))
    out = T.StructType()
    for name, members in groups.items():
        leaf = members[0] if members[0][0] == [] else None
        out.add(name, TYPES[leaf[1]] if leaf else _nest(members))
    return out


def item_schema(entity: str) -> T.StructType:
    """Nested type of one API item."""
    return _nest([(f.path.split("."), f.arrives) for f in ITEM_FIELDS[entity]])


def envelope_schema(entity: str) -> T.StructType:
    """Type of one API response document: the item list and the text of a broken document."""
    return T.StructType(
        [
            T.StructField("items", T.ArrayType(item_schema(entity))),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )
