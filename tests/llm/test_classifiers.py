import random
import zlib

import numpy as np
import pytest

from metricloom.llm import quality, toxicity
from metricloom.llm.common import table
from metricloom.llm.fuzzy import FuzzyLexicon, edits
from metricloom.llm.labelled import held_out
from tests.llm.conftest import clashing

SMALL = "/root/testdata/sf0.01"


def labels(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("score, label", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_held_out_accuracy(spark, score, label):
    docs, known = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    rows = score(docs, known).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    truth = {r.doc_id: r[label] for r in known.collect()}
    seen = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in seen) / len(seen) > 0.93


def test_held_out_labels_are_not_learned(spark):
    docs, known = table(spark, SMALL, "documents"), table(spark, SMALL, "labels").collect()
    flipped = labels(spark, *[(r.doc_id, r.quality ^ (zlib.crc32(str(r.doc_id).encode()) % 5 == 0), r.toxic ^ (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)) for r in known])
    same = labels(spark, *[(r.doc_id, r.quality, r.toxic) for r in known])
    for score in (quality.quality_scores, toxicity.toxicity_scores):
        one, two = ({r.doc_id: r.score for r in score(docs, x).collect()} for x in (same, flipped))
        assert one.keys() == two.keys() and max(abs(one[i] - two[i]) for i in one) < 1e-6


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_awkward_rows_and_little_to_learn(spark, awkward, score):
    none = labels(spark)
    one_sort = labels(spark, (1, 1, 0), (2, 1, 0), (3, None, None), (None, 1, 1), (4, 7, 9))
    both = labels(spark, *[(i, i % 2, i % 2) for i in range(1, 10)])
    for docs in (awkward, clashing(awkward), awkward.where("false")):
        for known in (none, one_sort, both):
            assert score(docs, known).count() == docs.count()
    kept = toxicity.without_toxic(awkward, none)
    assert kept.columns == awkward.columns and kept.count() == 10


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_fuzzy_matches_are_those_by_force():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    entries = list({(word(rng.randint(3, 11)), rng.random() < 0.3): None for _ in range(30)})
    lexicon = FuzzyLexicon([(t, s, edits(t)) for t, s in entries], kept=50)
    for _ in range(2000):
        w = word(rng.randint(0, 13))
        near = {}
        for number, (term, is_stem) in enumerate(entries):
            spent = min(distance(term, w[:n]) for n in range(len(w) + 1)) if is_stem else distance(term, w)
            if spent <= edits(term):
                near[number] = spent
        assert lexicon.matches(w) == near


WEIGHTS = (7.0, 4.0, 3.0, 2.0)


def test_stems_and_context():
    describer = toxicity.Describer([toxicity.Term("moron", False, WEIGHTS), toxicity.Term("lowei", True, WEIGHTS), toxicity.Term("nearby", False, (5.0, 0.0, 0.0, 0.0))])
    place = dict(zip(toxicity.FEATURES, range(len(toxicity.FEATURES)), strict=True))
    at = lambda text, name: describer.features(text)[place[name]]
    assert at("so ein loweichen da", "stem") > at("so ein lxweichen da", "stem") > 0
    assert at("what a moron", "word") > at("what a morron", "word") > at("what a 0oron", "word") > 0
    assert at('he wrote "moron" there', "quoted") > 0 and at('he wrote "moron" there', "word") == 0
    assert at("he wrote morron there", "quoted") > 0 and at("he wrote morron there", "word") == 0
    assert at("you moron", "addressed") > 0
    assert at("he is nearb", "word") == 0 < at("he is nearby", "word")
    assert not any(describer.features("")[:-1])


def test_quotation_marks_are_sought_where_the_hit_is():
    describer = toxicity.Describer([toxicity.Term("moron", False, WEIGHTS)])
    quoted = toxicity.FEATURES.index("quoted")
    # The capital I with a dot has two letters when lowered.
    assert describer.features("\u0130" * 30 + ' "moron" here')[quoted] > 0
    assert describer.features('"' + "\u0130" * 20 + '" moron here "x"')[quoted] == 0


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "KEPT_WORDS", 50)
    describer = toxicity.Describer([toxicity.Term("moron", False, WEIGHTS)])
    for i in range(40):
        describer.features(" ".join(f"mor{i}n{j}" for j in range(10)) + " moron morons")
        assert len(describer.known) <= 50 + 12


def test_misspelled_and_quoted_terms_of_held_out_documents(spark):
    """Every word that hits as written is changed by one letter, or put in quotation marks, in the toxic documents that are found as
    written. Of those with clear insults at least 0.8 are still found; of all, where the lexicon also has mere beginnings that prose comes near, 0.6."""
    docs, known = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    describer, model = toxicity.train(docs.select("doc_id", "text"), known)
    rng = random.Random(1)

    def toxic(text):
        return float(np.dot(describer.features(text), model[:-1]) + model[-1]) >= 0

    def entries(word):
        return [describer.lexicon[e] for e, spent in describer.fuzzy.matches(word.lower()).items() if spent == 0]

    def clear(text):
        return any(not t.is_stem and t.weights[0] > 5 for w in toxicity.WORD.findall(text) for t in entries(w))

    def changed(text, how):
        def one(match):
            word, met = match[0], entries(match[0])
            if not met:
                return word
            if how == "quoted":
                return f'"{word}"'
            i = 0 if how == "first" else rng.randrange(1, min(len(t.text) for t in met))
            return rng.choice([word[:i] + "0" + word[i + 1 :], word[:i] + "q" + word[i + 1 :], word[:i] + "x" + word[i:], word[:i] + word[i + 1 :]])

        return toxicity.WORD.sub(one, text)

    rows = docs.join(known, "doc_id").where(held_out()).select("text", "toxic").collect()
    found = [r.text for r in rows if r.toxic and toxic(r.text)]
    insults = [text for text in found if clear(text)]
    assert len(found) > 0.85 * sum(r.toxic for r in rows) and len(insults) > 0.5 * len(found)
    for how in ("inside", "first"):
        assert sum(toxic(changed(text, how)) for text in insults) >= 0.8 * len(insults)
        assert sum(toxic(changed(text, how)) for text in found) >= 0.6 * len(found)
    assert sum(toxic(changed(text, "quoted")) for text in found) < 0.2 * len(found)
    others = [r.text for r in rows if not r.toxic]
    assert sum(map(toxic, others)) < 0.02 * len(others)


def test_logistic_regression_finds_the_rule():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 3))
    beta = toxicity.fit_logistic(x, (x[:, 0] - 0.5 * x[:, 1] > 0.2).astype(float))
    assert beta[0] > 1 and beta[1] < -0.5 and abs(beta[2]) < 0.2 and beta[3] < 0


def test_discriminant_against_plain_densities(spark):
    """Means, shrunk covariances, determinants and inverses written out, without moments over Spark or Cholesky factors."""
    random = np.random.default_rng(5)
    shapes = {k: random.normal(size=(quality.WIDTH, quality.WIDTH)) for k in (0, 1)}
    rows = {k: random.normal(size=(n, quality.WIDTH)) @ shapes[k] + 2 * k for k, n in ((0, 150), (1, 90))}
    labelled = spark.createDataFrame([(k, x.tolist()) for k in rows for x in rows[k]], "label int, x array<double>").repartition(5)
    covariance = {k: np.cov(rows[k], rowvar=False, bias=True) for k in rows}
    pooled = (150 * covariance[0] + 90 * covariance[1]) / 240
    asked = random.normal(size=(40, quality.WIDTH)) * 3
    density = {}
    for k in rows:
        c = covariance[k] * (1 - quality.SHRINK_TO_POOLED) + pooled * quality.SHRINK_TO_POOLED
        c = c * (1 - quality.SHRINK_TO_DIAGONAL) + np.diag(np.diag(c)) * quality.SHRINK_TO_DIAGONAL + quality.RIDGE * np.eye(quality.WIDTH)
        away = asked - rows[k].mean(axis=0)
        density[k] = np.array([-0.5 * a @ np.linalg.inv(c) @ a for a in away]) - 0.5 * np.linalg.slogdet(c)[1]
    odds = (density[1] - density[0]) / quality.TEMPERATURE + np.log(90 / 150)
    expected = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
    assert np.allclose(quality.fit(labelled).scores(asked), expected, atol=1e-9)
