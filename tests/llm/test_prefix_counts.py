import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metricloom.llm import prefix_counts
from metricloom.llm.common import table
from metricloom.llm.queries import VOCABULARY, op11_token_counts
from tests.conftest import SMALL
from tests.llm.conftest import clashing


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def counter():
    return prefix_counts.load_counter(VOCABULARY)


def by_force(library, text):
    return [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]


LETTERS = "abcdeinothrsl'’.,!?0129²½<|>_- \t\n\r\x0b\x1c\x85\xa0 ABÉİΣςßñ中文🙂é́각ǅ"
SPECIAL = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|", "'re", "'s", "hello", "a", " ", "|>", "é", "́"])


@given(st.one_of(st.text(LETTERS, max_size=40), st.text("aehn", max_size=40), st.text(max_size=30), st.lists(SPECIAL, max_size=8).map("".join)))
@settings(max_examples=600, deadline=None)
def test_every_prefix_counts_as_in_the_library(library, counter, text):
    assert prefix_counts.counts(counter.table(text)).tolist() == by_force(library, text)


@pytest.mark.parametrize(
    "text",
    ["a<|endoftext|>b <|startoftext|>", "x'<|endoftext|>'s", "haha" * 40, "!" * 90, "I'LL don't 'story 'S", "ａｂ ǅ ½ 中文字,中文", "hello,World42x", "cafés ΑΣ ΑΣΑ İx"],
)
def test_special_cases(library, counter, text):
    assert prefix_counts.counts(counter.table(text)).tolist() == by_force(library, text)


def test_differences_that_need_more_bytes(counter, library, monkeypatch):
    text = "hello big world"
    monkeypatch.setattr(counter, "chunk", lambda c: [300] * len(c))
    monkeypatch.setattr(counter, "kept", prefix_counts.Kept(counter))
    made = counter.table(text)
    assert made[:1] == prefix_counts.WIDE
    assert prefix_counts.counts(made)[-1] == 300 * 13 and len(prefix_counts.counts(made)) == len(text) + 1


def test_memory_stays_in_bounds(library):
    small = prefix_counts.load_counter(VOCABULARY)
    small.room = 5
    text = " ".join(f"word{i} other," for i in range(40))
    for _ in range(3):
        assert prefix_counts.counts(small.table(text))[-1] == len(library.encode(text, add_special_tokens=False).ids)
    assert len(small.kept) <= 5 and len(small.pieces) <= 5


def test_awkward_rows(awkward, library):
    for docs in (awkward, clashing(awkward), awkward.where("false")):
        expected = sorted((len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
        rows = prefix_counts.token_counts(docs, VOCABULARY).collect()
        assert sorted((r.n_bytes, r.n_tokens) for r in rows) == expected
        assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)
        tables = prefix_counts.prefix_tables(docs, VOCABULARY)
        assert sorted((r.n_bytes, r.n_tokens) for r in tables.collect()) == expected


def test_truncation_by_stored_tables(spark, documents, library, tmp_path):
    texts = ["", "hello", "the quick brown fox, jumped! over 12 lazy dogs", "haha" * 20, "x'<|endoftext|> don't", None]
    docs = documents(*enumerate(texts))
    path = str(tmp_path / "tables")
    prefix_counts.prefix_tables(docs, VOCABULARY).write.parquet(path)
    stored = spark.read.parquet(path)
    rows = prefix_counts.truncation_points(stored, [0, 1, 3, 5, 1000]).collect()
    assert len(rows) == 5 * len(texts)
    for r in rows:
        every = by_force(library, texts[r.doc_id] or "")
        best = max(k for k, n in enumerate(every) if n <= r.budget)
        assert (r.n_chars, r.n_tokens) == (best, every[best])
    for r in prefix_counts.tokens_of_prefix(stored, F.lit(7)).collect():
        every = by_force(library, texts[r.doc_id] or "")
        assert r.n_tokens == every[min(7, len(every) - 1)]
    with pytest.raises(ValueError, match="budget"):
        prefix_counts.truncation_points(stored, [-1])


def test_query_counts_as_the_library_does(spark, library):
    rows = {r.doc_id: r for r in op11_token_counts(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        n = len(library.encode(d.text or "", add_special_tokens=False).ids)
        assert (rows[d.doc_id].n_tokens, rows[d.doc_id].n_bytes, rows[d.doc_id].over_limit) == (n, len((d.text or "").encode()), n > 2048)
