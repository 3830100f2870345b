import random

import pytest
from pyspark.sql import functions as F

from metricloom.functions import NETWORKS, keyword_count, keyword_counts, strip_punct, word_count
from metricloom.functions.text import PUNCTUATION

WORD_VECTORS = [
    ("a b", 2),
    ("a  b", 3),
    (" a b", 3),
    ("a b ", 2),
    (" ", 0),
    ("", 1),
    ("!!!", 1),
    ("a\nb c", 2),
    ("! !", 0),
    ("it's ok - yes", 4),
    ("é—x y", 2),
    ("a\tb", 1),
    ("x   ", 1),
    (None, None),
    (" !", 0),
    ("! a", 2),
    ("a !  !", 1),
    ("a ! b", 3),
    ("—", 1),
]


def clean(text):
    return "".join(c for c in text if c not in PUNCTUATION)


def words_of(text):
    """Words between single spaces; empty ones at the end are dropped."""
    if " " not in text:
        return [text]
    words = text.split(" ")
    while words and words[-1] == "":
        words.pop()
    return words


def random_texts(count, alphabet, longest=40):
    rng = random.Random(7)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(count)]


def test_punctuation_is_the_ascii_set():
    assert len(set(PUNCTUATION)) == 32
    assert all(33 <= ord(c) <= 126 and not c.isalnum() for c in PUNCTUATION)


@pytest.mark.parametrize(("text", "expected"), WORD_VECTORS)
def test_word_count_vectors(column, text, expected):
    assert column([text], "string", word_count("c")) == [expected]


def test_word_count_vectors_without_ansi(column, ansi):
    texts = [t for t, _ in WORD_VECTORS]
    assert column(texts, "string", word_count("c")) == [n for _, n in WORD_VECTORS]


def test_word_count_against_brute_force(column):
    texts = random_texts(3000, "ab  !.-_é—\t\n😀")
    assert column(texts, "string", word_count("c")) == [len(words_of(clean(t))) for t in texts]


def test_word_count_of_a_very_long_text(column):
    assert column(["word, " * 200_000], "string", word_count("c")) == [200_000]


def test_strip_punct_keeps_unicode_dashes(column):
    assert column(["a-b—c!«d»" + PUNCTUATION, None], "string", strip_punct("c")) == ["ab—c«d»", None]


def test_keyword_count_vectors(column):
    texts = [
        "Follow @Instagram, instagram! facebook.com",
        "instagram\ninstagram",
        "instagram instagram  instagram instagram",
        "in.sta.gram #INSTAGRAM",
        "xinstagram instagramx",
        "",
        None,
    ]
    assert column(texts, "string", keyword_count("c", "instagram")) == [2, 0, 4, 2, 0, 0, None]
    assert column(texts[:1], "string", keyword_count("c", "facebook")) == [0]


def test_keyword_that_can_never_be_a_word_counts_zero(column):
    assert column(["a b A a.b"], "string", keyword_count("c", "a b")) == [0]
    assert column(["a b A a.b"], "string", keyword_count("c", "A")) == [0]
    assert column(["a b A a.b"], "string", keyword_count("c", "a.b")) == [0]


def test_empty_keyword_is_refused():
    with pytest.raises(ValueError):
        keyword_count("c", "")


@pytest.mark.parametrize("words", [("ab", "b", "kak"), ("ab", "é"), ("a b", "a.b")])
def test_keyword_counts_against_brute_force(spark, words):
    # U+212A lower-cases to an ASCII k, U+017F upper-cases to an ASCII S.
    texts = random_texts(4000, "aAbB  .!kKKſé\n", longest=30)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    counted = keyword_counts(rows, "c", words).orderBy("i").collect()
    expected = [[words_of(clean(t).lower()).count(w) for w in words] for t in texts]
    assert [[r[f"{w}_count"] for w in words] for r in counted] == expected


def test_network_counts_against_brute_force(spark):
    rng = random.Random(3)
    pieces = [*NETWORKS, "@Instagram!", "face-book", "TikToK", "FACEBOOK", "\n", "twitter.com", "the", ""]
    texts = [rng.choice([" ", "  ", " - "]).join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(1000)]
    rows = spark.createDataFrame([*enumerate(texts), (-1, None)], "i int, c string")
    counted = {r.i: r for r in keyword_counts(rows, "c").collect()}
    for i, text in enumerate(texts):
        words = words_of(clean(text).lower())
        assert [counted[i][f"{n}_count"] for n in NETWORKS] == [words.count(n) for n in NETWORKS], text
    assert all(counted[-1][f"{n}_count"] is None for n in NETWORKS)
    assert keyword_counts(rows, "c").columns == ["i", "c", *[f"{n}_count" for n in NETWORKS]]


def test_very_long_texts_and_runs(spark):
    texts = [
        "word twit-ter, " * 100_000,
        "!" * 1_000_000,
        " f" + "!" * 1_000_000 + "acebook",
        " " * 1_000_000,
        " reddit" * 100_000,
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    counted = keyword_counts(rows, "c").orderBy("i").collect()
    assert [(r.twitter_count, r.facebook_count, r.reddit_count) for r in counted] == [
        (100_000, 0, 0),
        (0, 0, 0),
        (0, 1, 0),
        (0, 0, 0),
        (0, 0, 100_000),
    ]
    lengths = rows.select("i", word_count("c").alias("n"), F.length(strip_punct("c")).alias("left")).orderBy("i").collect()
    assert [r.n for r in lengths] == [200_000, 1, 2, 0, 100_001]
    assert [r.left for r in lengths][1] == 0


def test_no_python_and_one_stage(spark):
    rows = spark.range(1).select(F.lit("a").alias("c"))
    plan = keyword_counts(rows, "c").select("*", word_count("c"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
