"""The test tables seen as the four entities, in Spark and in SQL.

Publish times are instants; the SQL sees them as UTC wall-clock timestamps. Results show
them as milliseconds so that no session zone enters the comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.functions.dates import duration_seconds
from metricloom.functions.lookup import CATEGORIES, SPACED_CATEGORIES, with_category
from metricloom.functions.text import NETWORKS
from metricloom.plans.dated import with_publish_period
from metricloom.plans.enrich import ENRICH, enrich_videos
from metricloom.schemas import TABLE_COLUMNS
from metricloom.workload.registry import table

MS_PER_HOUR = 3_600_000
# Columns with missing values that results show in another type.
SHOWN = {"made_for_kids": "string", "duration_seconds": "double", "duration_seconds_sum": "double"}
# Days since 1970-01-01 of the first publish day of each entity.
FIRST_DAY = {"channels": 14_610, "playlists": 15_340, "videos": 16_436, "comments": 17_532}


def _instant(first_day: int, day: Column, hour: Column) -> Column:
    return F.timestamp_millis(((day + first_day) * 24 + hour) * MS_PER_HOUR)


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.cast("string").alias("channel_id"),
            F.col("c_name").alias("channel_title"),
            F.col("c_mktsegment").alias("channel_description"),
            _instant(FIRST_DAY["channels"], key % 4000, key % 24).alias("published_at"),
            F.when(key % 11 != 0, F.col("n_name")).alias("country"),
            (key * 7).alias("subscriber_count"),
            (key % 100).cast("int").alias("video_count"),
            F.round(F.col("c_acctbal") * 100).cast("bigint").alias("view_count"),
        )
    )


def playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("playlist_id"),
        F.col("p_name").alias("playlist_title"),
        F.col("p_type").alias("playlist_description"),
        _instant(FIRST_DAY["playlists"], key % 3000, key % 24).alias("published_at"),
        F.concat(F.lit("id "), F.col("p_brand")).alias("channel_id"),
        F.col("p_brand").alias("channel_title"),
        F.col("p_size").alias("videos_count"),
    )


def duration_text() -> Column:
    """Durations of several shapes from the text length, with days and gaps among them."""
    n, key = F.col("n_chars"), F.col("doc_id")
    hours, minutes, seconds = _div(n, 3600).cast("string"), _div(n % 3600, 60).cast("string"), (n % 60).cast("string")
    full = F.concat(F.lit("PT"), hours, F.lit("H"), minutes, F.lit("M"), seconds, F.lit("S"))
    return (
        F.when(key % 29 == 0, None)
        .when(key % 7 == 1, F.concat(F.lit("PT"), minutes, F.lit("M")))
        .when(key % 7 == 2, "P1D")
        .when(key % 7 == 3, F.concat(F.lit("P1DT"), minutes, F.lit("M")))
        .when(key % 7 == 4, F.concat(F.lit("PT"), hours, F.lit("H"), seconds, F.lit("S")))
        .otherwise(full)
    )


def mention() -> Column:
    """A network name with punctuation around it, chosen by document."""
    return F.concat(F.lit(" @"), F.element_at(F.array(*map(F.lit, NETWORKS)), (F.col("doc_id") % 7 + 1).cast("int")), F.lit("!"))


def raw_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos before the category lookup, with their duration text."""
    key, n = F.col("doc_id"), F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        key.cast("string").alias("video_id"),
        _instant(FIRST_DAY["videos"], key % 2000, key % 24).alias("published_at"),
        F.concat(F.lit("id "), F.col("source")).alias("channel_id"),
        F.col("source").alias("channel_title"),
        F.concat(F.lit("doc "), key.cast("string")).alias("video_title"),
        F.concat(F.col("text"), mention()).alias("video_description"),
        n.alias("view_count"),
        (n % 97).cast("int").alias("like_count"),
        (n % 13).cast("int").alias("comment_count"),
        (key % 46 + 1).cast("int").alias("category_id"),
        F.when(key % 13 != 0, F.col("lang")).alias("language"),
        duration_text().alias("duration"),
        F.when(key % 3 < 2, key % 3 == 0).alias("made_for_kids"),
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_category(raw_videos(spark, sf_dir))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv, turn, role = F.col("conv_id"), F.col("turn"), F.col("role")
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", conv, turn).alias("comment_id"),
        conv.cast("string").alias("video_id"),
        F.col("text").alias("comment_text"),
        role.alias("comment_author_channel_name"),
        F.concat(F.lit("id "), role).alias("comment_author_channel_id"),
        F.concat(F.lit("https://channels.example/"), role).alias("comment_author_channel_url"),
        turn.cast("int").alias("comment_like_count"),
        _instant(FIRST_DAY["comments"], conv % 1000, turn % 24).alias("published_at"),
        (turn % 4).cast("int").alias("total_reply_count"),
    )


BOUND = {"channels": channels, "playlists": playlists, "videos": videos, "comments": comments}


def cleansed(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The bound table in the columns of the cleansed table."""
    return BOUND[entity](spark, sf_dir).select(*TABLE_COLUMNS[entity])


def as_epoch_text(df: DataFrame) -> DataFrame:
    """``df`` with publish times as epoch-millis text."""
    return df.withColumn("published_at", F.unix_millis("published_at").cast("string"))


def reported(spark: SparkSession, sf_dir: str, entity: str, networks: Sequence[str] = NETWORKS) -> DataFrame:
    """The bound table enriched and dated, as the reports read it; of the network counts those named."""
    df = BOUND[entity](spark, sf_dir)
    if entity == "videos":
        df = enrich_videos(df, networks)
    elif entity in ENRICH:
        df = ENRICH[entity](df)
    if entity == "videos":
        df = df.select("*", duration_seconds("duration").alias("duration_seconds"))
    return with_publish_period(as_epoch_text(df))


def show_times(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with instants as ``<column>_ms``, and the rest as ``shown``."""
    for c in columns or ("published_at",):
        df = df.withColumn(f"{c}_ms", F.unix_millis(c)).drop(c)
    return shown(df)


def shown(df: DataFrame) -> DataFrame:
    """``df`` with its columns of missing whole numbers as doubles and of missing booleans
    as text: a NULL among those looks different in each data frame library."""
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in SHOWN.items() if c in df.columns})


# --- the same bindings in SQL ---------------------------------------------------------


def _at(first: str, day: str, hour: str) -> str:
    return f"TIMESTAMP '{first}' + to_days(CAST({day} AS INTEGER)) + to_hours({hour})"


def word_count_sql(text: str) -> str:
    clean = f"regexp_replace({text}, '[[:punct:]]', '', 'g')"
    body = f"rtrim({clean}, ' ')"
    return (
        f"CAST(CASE WHEN {text} IS NULL THEN NULL WHEN {clean} = '' THEN 1 WHEN {body} = '' THEN 0 "
        f"ELSE length({body}) - length(replace({body}, ' ', '')) + 1 END AS INTEGER)"
    )


def keyword_count_sql(text: str, word: str) -> str:
    words = f"string_split(lower(regexp_replace({text}, '[[:punct:]]', '', 'g')), ' ')"
    return f"CAST(len(list_filter({words}, lambda w: w = '{word}')) AS INTEGER)"


def duration_sql(text: str) -> str:
    def part(n: int) -> str:
        found = f"regexp_extract({text}, '^PT(?:(\\d+)H)?(?:(\\d+)M)?(?:(\\d+)S)?$', {n})"
        return f"CAST(coalesce(nullif({found}, ''), '0') AS INTEGER)"

    return (
        f"CASE WHEN {text} IS NULL THEN NULL WHEN NOT regexp_matches({text}, '[HMS]') THEN 0 "
        f"WHEN regexp_matches({text}, '^PT(?:(\\d+)H)?(?:(\\d+)M)?(?:(\\d+)S)?$') "
        f"THEN {part(1)} * 3600 + {part(2)} * 60 + {part(3)} END"
    )


# The category ids and names once more, so that the SQL does not rest on the engine's own map.
_CATEGORY_SQL = """
WHEN 1 THEN 'Film & Animation' WHEN 2 THEN 'Autos & Vehicles' WHEN 10 THEN 'Music' WHEN 15 THEN 'Pets & Animals'
WHEN 17 THEN 'Sports' WHEN 18 THEN 'Short Movies' WHEN 19 THEN 'Travel & Events' WHEN 20 THEN 'Gaming'
WHEN 21 THEN 'Videoblogging' WHEN 22 THEN 'People & Blogs' WHEN 23 THEN 'Comedy' WHEN 24 THEN 'Entertainment'
WHEN 25 THEN 'News & Politics' WHEN 26 THEN 'Howto & Style' WHEN 27 THEN 'Education'
WHEN 28 THEN 'Science & Technology' WHEN 29 THEN 'Nonprofits & Activism' WHEN 30 THEN 'Movies'
WHEN 31 THEN 'Anime/Animation' WHEN 32 THEN 'Action/Adventure' WHEN 33 THEN 'Classics' WHEN 34 THEN 'Comedy'
WHEN 35 THEN 'Documentary' WHEN 36 THEN 'Drama' WHEN 37 THEN 'Family' WHEN 38 THEN 'Foreign' WHEN 39 THEN 'Horror'
WHEN 40 THEN 'Sci-Fi/Fantasy' WHEN 41 THEN 'Thriller' WHEN 42 THEN 'Shorts' WHEN 43 THEN 'Shows' WHEN 44 THEN 'Trailers'
"""


def category_sql(key: str, spaced: bool = False) -> str:
    names = f"CASE {key} {_CATEGORY_SQL} END"
    if not spaced:
        return names
    return (
        f"CASE {key} WHEN 31 THEN 'Anime / Animation' WHEN 32 THEN 'Action / Adventure' WHEN 40 THEN 'Sci - Fi / Fantasy' ELSE {names} END"
    )


CHANNELS_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS channel_id, c_name AS channel_title,
       c_mktsegment AS channel_description,
       {_at("2010-01-01", "c_custkey % 4000", "c_custkey % 24")} AS published_at,
       CASE WHEN c_custkey % 11 <> 0 THEN n_name END AS country,
       CAST(c_custkey * 7 AS BIGINT) AS subscriber_count, CAST(c_custkey % 100 AS INTEGER) AS video_count,
       CAST(round(c_acctbal * 100) AS BIGINT) AS view_count
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

PLAYLISTS_SQL = f"""
SELECT CAST(p_partkey AS VARCHAR) AS playlist_id, p_name AS playlist_title, p_type AS playlist_description,
       {_at("2012-01-01", "p_partkey % 3000", "p_partkey % 24")} AS published_at,
       'id ' || p_brand AS channel_id, p_brand AS channel_title, p_size AS videos_count
FROM part"""

_NETWORKS_SQL = ("facebook", "instagram", "twitter", "youtube", "tiktok", "reddit", "discord")
_NETWORK_LIST = ", ".join(f"'{n}'" for n in _NETWORKS_SQL)

VIDEOS_SQL = f"""
SELECT CAST(doc_id AS VARCHAR) AS video_id,
       {_at("2015-01-01", "doc_id % 2000", "doc_id % 24")} AS published_at,
       'id ' || source AS channel_id, source AS channel_title, 'doc ' || doc_id AS video_title,
       text || ' @' || ([{_NETWORK_LIST}])[CAST(doc_id % 7 + 1 AS INTEGER)] || '!' AS video_description,
       n_chars AS view_count, CAST(n_chars % 97 AS INTEGER) AS like_count,
       CAST(n_chars % 13 AS INTEGER) AS comment_count,
       CAST(doc_id % 46 + 1 AS INTEGER) AS category_id,
       {category_sql("(doc_id % 46 + 1)")} AS category,
       CASE WHEN doc_id % 13 <> 0 THEN lang END AS language,
       CASE WHEN doc_id % 29 = 0 THEN NULL
            WHEN doc_id % 7 = 1 THEN 'PT' || (n_chars % 3600 // 60) || 'M'
            WHEN doc_id % 7 = 2 THEN 'P1D'
            WHEN doc_id % 7 = 3 THEN 'P1DT' || (n_chars % 3600 // 60) || 'M'
            WHEN doc_id % 7 = 4 THEN 'PT' || (n_chars // 3600) || 'H' || (n_chars % 60) || 'S'
            ELSE 'PT' || (n_chars // 3600) || 'H' || (n_chars % 3600 // 60) || 'M' || (n_chars % 60) || 'S'
       END AS duration,
       CASE WHEN doc_id % 3 < 2 THEN doc_id % 3 = 0 END AS made_for_kids
FROM documents"""

COMMENTS_SQL = f"""
SELECT conv_id || '-' || turn AS comment_id, CAST(conv_id AS VARCHAR) AS video_id, text AS comment_text,
       role AS comment_author_channel_name, 'id ' || role AS comment_author_channel_id,
       'https://channels.example/' || role AS comment_author_channel_url,
       CAST(turn AS INTEGER) AS comment_like_count,
       {_at("2018-01-01", "conv_id % 1000", "turn % 24")} AS published_at,
       CAST(turn % 4 AS INTEGER) AS total_reply_count
FROM conversations"""

BOUND_SQL = {"channels": CHANNELS_SQL, "playlists": PLAYLISTS_SQL, "videos": VIDEOS_SQL, "comments": COMMENTS_SQL}

LENGTHS_SQL = {
    "playlists": f"{word_count_sql('playlist_title')} AS playlist_title_length",
    "comments": f"{word_count_sql('comment_text')} AS text_length",
    "videos": ", ".join(f"{keyword_count_sql('video_description', n)} AS {n}_count" for n in _NETWORKS_SQL),
}

PERIOD_SQL = "strftime(published_at, '%Y') AS \"year\", strftime(published_at, '%B') AS \"month\""


def columns_sql(entity: str, columns: tuple[str, ...] | None = None) -> str:
    """Select list of an entity's columns with publish times in milliseconds."""
    special = {
        "published_at": "epoch_ms(published_at) AS published_at_ms",
        "made_for_kids": "CAST(made_for_kids AS VARCHAR) AS made_for_kids",
    }
    return ", ".join(special.get(c, c) for c in columns or TABLE_COLUMNS[entity])


def reported_sql(entity: str) -> str:
    extra = [PERIOD_SQL]
    if entity in LENGTHS_SQL:
        extra.append(LENGTHS_SQL[entity])
    if entity == "videos":
        extra.append(f"{duration_sql('duration')} AS duration_seconds")
    return f"SELECT *, {', '.join(extra)} FROM ({BOUND_SQL[entity]}) AS bound"
