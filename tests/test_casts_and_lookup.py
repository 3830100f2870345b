from datetime import datetime

import pytest
from pyspark.sql import functions as F

from metricloom.functions import category_name, document_instant, to_instant, to_int, to_key, to_long, with_category
from metricloom.functions.lookup import CATEGORIES

NUMBERS = [
    ("5", 5, 5),
    (" 7 ", 7, 7),
    ("-3", -3, -3),
    ("12.9", 12, 12),
    ("-12.9", -12, -12),
    ("1e3", None, None),
    ("abc", None, None),
    ("", None, None),
    ("99999999999", 99999999999, None),
    ("99999999999999999999", None, None),
    (None, None, None),
]


def test_numbers_from_text(column, ansi):
    found = column([n[0] for n in NUMBERS], "string", to_long("c"), to_int("c"))
    # Without ANSI rules the plain cast cuts fractions by itself; results are the same.
    assert found == [n[1:] for n in NUMBERS]


def test_double_to_long(column):
    assert column([3.99, -3.99, 1e30, None], "double", to_long("c")) == [3, -3, None, None]


def test_instants(spark, zone):
    texts = ["2020-03-08T10:30:00Z", "2020-03-08T10:30:00.123Z", "2020-03-08T12:30:00+02:00", "soon", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    millis = [r[1] for r in rows.select("i", F.unix_millis(to_instant("c"))).orderBy("i").collect()]
    assert millis == [1583663400000, 1583663400123, 1583663400000, None, None, None]


def test_key(column):
    assert column([datetime(2020, 1, 2, 3, 4, 5)], "timestamp_ntz", to_key("c")) == ["2020-01-02 03:04:05"]


def test_categories(column):
    assert len(CATEGORIES) == 32
    assert column([10, 3, None, 31, 23, 34], "int", category_name("c"), category_name("c", spaced=True)) == [
        ("Music", "Music"),
        (None, None),
        (None, None),
        ("Anime/Animation", "Anime / Animation"),
        ("Comedy", "Comedy"),
        ("Comedy", "Comedy"),
    ]
    ids = sorted(CATEGORIES)
    assert column(ids, "int", category_name("c")) == [CATEGORIES[i] for i in ids]


def test_category_costs_nothing_when_unused(spark):
    rows = spark.range(3).select(F.col("id").cast("int").alias("category_id"))
    plan = with_category(rows).groupBy("category_id").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Music" not in plan and "Join" not in plan


@pytest.mark.parametrize("text", ["2020-03-08T10:30:00Z", "2020-03-08 10:30:00+00:00", "2020-03-08T12:30:00+02:00", "2020-03-08T10:30:00", "2020-3-8 10:30:00.000"])
def test_instants_in_any_zone(column, zone, ansi, text):
    assert column([text], "string", F.unix_millis(to_instant("c"))) == [1583663400000]


@pytest.mark.parametrize("text", ["12:34", "2020", "2020-03-08T10:30", "2020-03-08", "T10:30:00Z", "2020-03-08T10:30:00Z\n", "2020-13-08T10:30:00Z", "", "now", None])
def test_what_is_no_instant(column, zone, ansi, text):
    assert column([text], "string", to_instant("c")) == [None]


def test_document_times_have_one_form(column, zone, ansi):
    texts = ["2020-03-08T10:30:00Z", "2020-03-08 10:30:00Z", "2020-03-08T10:30:00+02:00", "2020-03-08T10:30:00.5Z", "12:34", None]
    assert column(texts, "string", F.unix_millis(document_instant("c"))) == [1583663400000, None, None, None, None, None]
