"""Category names by id, from a fixed dimension of 32 rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Category id -> name.
CATEGORIES = {
    1: "Film & Animation",
    2: "Autos & Vehicles",
    10: "Music",
    15: "Pets & Animals",
    17: "Sports",
    18: "Short Movies",
    19: "Travel & Events",
    20: "Gaming",
    21: "Videoblogging",
    22: "People & Blogs",
    23: "Comedy",
    24: "Entertainment",
    25: "News & Politics",
    26: "Howto & Style",
    27: "Education",
    28: "Science & Technology",
    29: "Nonprofits & Activism",
    30: "Movies",
    31: "Anime/Animation",
    32: "Action/Adventure",
    33: "Classics",
    34: "Comedy",
    35: "Documentary",
    36: "Drama",
    37: "Family",
    38: "Foreign",
    39: "Horror",
    40: "Sci-Fi/Fantasy",
    41: "Thriller",
    42: "Shorts",
    43: "Shows",
    44: "Trailers",
}
# The spaced spelling used on streams.
SPACED_CATEGORIES = {
    31: "Anime / Animation",
    32: "Action / Adventure",
    40: "Sci - Fi / Fantasy",
}


def category_name(c: Column | str, spaced: bool = False) -> Column:
    """Name of a category id; an unknown or missing id gives NULL.

    The dimension is fixed, so it is a map literal in the plan: no join or broadcast job,
    nothing to compute when the name is not used, and the same on a stream.
    """
    names = {**CATEGORIES, **SPACED_CATEGORIES} if spaced else CATEGORIES
    pairs = [x for k, v in names.items() for x in (F.lit(k).cast("int"), F.lit(v))]
    return F.element_at(F.create_map(*pairs), F.col(c) if isinstance(c, str) else c)


def with_category(df: DataFrame, spaced: bool = False) -> DataFrame:
    """``df`` plus ``category`` by ``category_id``."""
    return df.withColumn("category", category_name("category_id", spaced))
