import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from metricloom.llm import divergence
from tests.llm.conftest import clashing


def words(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_force(rows, least=10, top=10):
    groups, counts, df = defaultdict(set), Counter(), Counter()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        for w in words(text):
            counts[lang, source, w] += 1
        for w in set(words(text)):
            df[lang, w] += 1
    out = set()
    for lang, sources in groups.items():
        kept = sorted(w for (g, w), n in df.items() if g == lang and n >= least)

        def shares(sources, lang=lang, kept=kept):
            n = {w: sum(counts[lang, s, w] for s in sources) for w in kept}
            total = sum(n.values())
            return {w: 1 + 1_000_000_000 * (n[w] + 2) // (total + 2 * len(kept)) for w in kept}

        p, q = {s: shares([s]) for s in sources}, shares(sources)
        for s in sources:
            pairs = [(-sum((p[s][w] - p[o][w]) ** 2 // (p[s][w] + p[o][w]) for w in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-((p[s][w] - q[w]) ** 2 // (p[s][w] + q[w])), w.encode(), w) for w in kept if counts[lang, s, w] and p[s][w] > q[w]]
            out |= {(lang, s, "pair", item, -v, i) for i, (v, _, item) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", item, -v, i) for i, (v, _, item) in enumerate(sorted(terms)[:top], 1)}
    return out


def found(docs, **options):
    rows = [tuple(r) for r in divergence.audit(docs, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@given(st.lists(st.text("abcABé中 -1'\0", max_size=30), max_size=12), st.integers(1, 40))
@settings(max_examples=300, deadline=None)
def test_pointers_are_sorted_by_word_and_keep_the_order_of_equal_ones(texts, small):
    before, divergence.SMALL = divergence.SMALL, small
    try:
        data = b"\0".join(t.encode().translate(divergence.LETTERS) for t in texts)
        pointers = divergence.WordPointers(data)
        order, first = pointers.sort()
    finally:
        divergence.SMALL = before
    expected = sorted((w.encode(), i) for i, w in enumerate(w for t in texts for w in words(t)))
    assert [(pointers.word(i).encode(), i) for i in order.tolist()] == expected
    assert first.tolist() == [i == 0 or expected[i - 1][0] != w for i, (w, _) in enumerate(expected)]


def test_long_words_that_share_their_beginning(monkeypatch):
    monkeypatch.setattr(divergence, "SMALL", 4)
    random = np.random.default_rng(2)
    texts = ["a" * int(n) + "b" * int(m) for n, m in random.integers(0, 40, (500, 2))]
    pointers = divergence.WordPointers(b"\0".join(t.encode() for t in texts))
    order, _ = pointers.sort()
    assert [pointers.word(i) for i in order] == sorted(t for t in texts if t)


def made(documents, rows):
    return documents(*[(i, text, source) for i, (_, source, text) in enumerate(rows)]).drop("lang").join(
        documents(*[(i, "") for i in range(len(rows))]).sparkSession.createDataFrame([(i, lang) for i, (lang, _, _) in enumerate(rows)], "doc_id bigint, lang string"), "doc_id"
    )


@pytest.mark.parametrize("cells", [1 << 21, 12])
def test_audit_by_force(documents, monkeypatch, cells):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "SHARD_BYTES", 700)
    random = np.random.default_rng(4)
    vocabulary = [f"{a}{b}" for a in ("Term", "wort", "längerebezeichnung", "é") for b in "abcdefghij"]
    rows = []
    for i in range(300):
        lang = ("en", "de", None)[i % 3]
        source = None if i % 17 == 0 else f"s{int(random.zipf(1.5)) % 5}"
        weights = random.dirichlet(np.full(len(vocabulary), 0.3))
        rows.append((lang, source, " ".join(random.choice(vocabulary, random.integers(0, 25), p=weights))))
    rows += [("fr", "only", "x"), ("it", "a", "rare words"), ("it", "b", None), ("en", "empty", "")]
    docs = made(documents, rows).repartition(4)
    assert found(docs) == by_force(rows)
    assert found(docs, least_docs=1, top_terms=3) == by_force(rows, 1, 3)


def test_awkward_rows(awkward):
    for docs in (awkward, clashing(awkward)):
        rows = [(r.lang, r.source, r.text) for r in docs.collect()]
        for least in (1, 2, 10):
            assert found(docs, least_docs=least) == by_force(rows, least)
    assert found(awkward.where("false")) == set()


def test_ties_go_to_the_smaller_item(documents):
    rows = [("en", s, f"{w} same") for s, w in (("b", "u"), ("a", "v"), ("c", "w"), ("é", "z"))]
    docs = made(documents, rows)
    assert found(docs, least_docs=1) == by_force(rows, 1)


def test_shares_of_great_counts(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(divergence.share(F.lit((1 << 62) + 1), F.lit(1 << 62), F.lit(1 << 40)).alias("p")).first()
    assert row.p == 1 + 1_000_000_000 * ((1 << 62) + 3) // ((1 << 62) + (1 << 41))
