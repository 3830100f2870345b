import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from metricloom.llm import resampling
from metricloom.llm.common import table
from metricloom.llm.queries import op12_resampling
from tests.conftest import SMALL
from tests.llm.conftest import clashing


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def grams(text, longest):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def by_force(docs, target, longest=1, buckets=10_000, least=20, percent=10):
    """``{(doc_id, n_features, weight, score, rank)}``"""

    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for g in grams(text, longest):
                counts[bucket(g)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for doc_id, text in docs:
        mine = [gain[bucket(g)] for g in grams(text, longest)]
        weight = sum(mine) // len(mine) if mine else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(mine), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {}
    for place, r in enumerate(able[: len(able) * percent // 100], 1):
        ranks.setdefault(r[:4], []).append(place)
    return sorted(((*r[:4], ranks[r[:4]].pop(0) if ranks.get(r[:4]) else None) for r in rows), key=str)


def found(docs, target, **options):
    rows = resampling.resample(docs, target, **options).collect()
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in rows), key=str)


@given(st.text("abZ9 -\x00\n\x7fÄé中🙂", max_size=40), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_spans_are_those_of_all_word_runs(text, longest):
    n, buckets = resampling.Scanner(longest, 10_000).scan(text)
    assert n == len(words(text))
    assert buckets.tolist() == [zlib.crc32(g.encode()) % 10_000 for g in grams(text, longest)]


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 70_000}, {"percent": 100}])
def test_ranks_by_force(spark, documents, options, monkeypatch):
    random = np.random.default_rng(5)
    texts = [" ".join(f"w{n}" for n in random.zipf(1.4, random.integers(0, 60)) % 500) for _ in range(600)]
    rows = [(i, text) for i, text in enumerate(texts)] + [(7, texts[7]), (None, texts[8]), (None, texts[8])]
    target = [(f"b{i}", text.replace("w3", "x")) for i, text in enumerate(texts[:40])]
    docs = documents(*rows).repartition(5)
    expected = by_force(rows, [t for _, t in target], longest=options.get("longest", 1), buckets=options.get("buckets", 10_000), percent=options.get("percent", 10))
    assert found(docs, spark.createDataFrame(target, "item_id string, text string"), **options) == expected


def test_awkward_rows(spark, awkward):
    target = spark.createDataFrame([("1", None), ("2", "a b WORD")], "item_id string, text string")
    for docs in (awkward, clashing(awkward)):
        expected = by_force([(r.doc_id, r.text) for r in docs.collect()], [None, "a b WORD"], percent=100)
        assert found(docs, target, percent=100) == expected
        drawn = resampling.drawn_documents(docs, target, percent=100)
        assert drawn.columns == [*docs.columns, "rank"]
        assert sorted(r.doc_id for r in drawn.collect()) == [7, 8]
    assert found(awkward.where("false"), target) == []
    assert len(found(awkward, target.where("false"))) == 10


def test_ties_go_to_the_smaller_id_and_the_draw_is_whole(spark, documents, monkeypatch):
    monkeypatch.setattr(resampling, "noise", lambda seed: resampling.F.lit(0))
    docs = documents(*[(i, "same words " * 15) for i in range(250)]).repartition(7)
    rows = found(docs, spark.createDataFrame([], "item_id string, text string"))
    assert sorted((r[4], r[0]) for r in rows if r[4]) == [(i + 1, i) for i in range(25)]


def test_query_by_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    target = [r.text for r in table(spark, SMALL, "benchmark").collect()]
    rows = sorted(map(tuple, op12_resampling(spark, SMALL).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    assert rows == by_force(docs, target)
