import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def awkward(documents):
    """Nulls in every column, empty, repeated and long rows."""
    long = "word " * 30_000 + "x" * 50_000
    return documents(
        (1, None), (2, ""), (3, " \t\n"), (None, "a b c"), (5, "a  b\tc"), (5, "a  b\tc"), (7, long), (8, long), (9, "a b c", None), (None, None, None)
    )


def clashing(df):
    """The same rows with more columns, named as operators name theirs."""
    from pyspark.sql import functions as F

    names = ("hash", "length", "fp", "ids", "score", "label", "copies", "row", "size", "count", "id", "h", "k", "root", "key", "v", "x")
    inner = ("__hash", "__h", "__len", "__length", "__copy", "__copies", "__id", "__taken", "__row", "__text", "no_id", "in_source", "no_source", "text_hash", "col")
    return df.withColumns({n: F.lit("clash") for n in (*names, *inner)})


def unchanged(df):
    """Whether the rows still have the values that ``clashing`` gave them."""
    extra = [c for c in clashing(df.limit(0)).columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    return set(df.columns) >= set(extra) and all(r[c] == "clash" for r in df.collect() for c in extra)
