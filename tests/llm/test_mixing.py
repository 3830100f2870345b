from pyspark.sql import functions as F

from metricloom.llm import mixing
from tests.llm.conftest import clashing, unchanged


def targets_by_force(sizes):
    """Share all words by weight; cap and share the excess again until nothing is above."""
    sources = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sources)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in sources if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] >= 3 * sizes[s]]
        if not above:
            return {**share, **fixed}
        fixed |= {s: 3 * sizes[s] for s in above}


def test_targets_and_taken_words(documents):
    docs = documents(*[(i, "w " * (i % 17), f"s{i % 7 if i % 3 else 0}" if i % 11 else None) for i in range(2000)])
    rows = mixing.mix(docs).collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    expected = targets_by_force(sizes)
    taken = {}
    for r in rows:
        assert abs(r.target - expected[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - expected[s]) <= 8.5 for s in sizes)
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_awkward_rows(awkward):
    for docs in (awkward, clashing(awkward)):
        rows = mixing.mix(docs).collect()
        assert len(rows) == 10 and sum(r.size == 0 for r in rows) == 4
        mixed = mixing.mixed_documents(docs)
        assert mixed.columns == docs.columns
        words = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0))
        assert mixed.agg(F.sum(words)).first()[0] == sum(r.taken for r in rows)
    assert unchanged(mixed)
    assert mixing.mix(awkward.where("false")).count() == 0
    assert mixing.mixed_documents(awkward.where("false")).count() == 0


def test_a_source_without_words_takes_nothing(documents):
    rows = mixing.mix(documents((1, "", "a"), (2, "x y", "b"))).collect()
    assert {(r.source, r.target, r.taken) for r in rows} == {("a", 0.0, 0), ("b", 2.0, 2)}


def test_one_document_in_two_sources_is_taken_by_each(documents):
    docs = documents(*[(i, f"w{i} " * (i % 9 + 1), "AAAAAAAAAB"[i % 10]) for i in range(300)], (1000, "the same words here", "A"), (1000, "the same words here", "B"), (1001, "x y", None), (1001, "x y", ""))
    rows = mixing.mix(docs).collect()
    copies = sorted((r.doc_id, str(r.source)) for r in rows for _ in range(r.copies))
    assert len({r.copies for r in rows if r.doc_id == 1000}) == 2
    assert sorted((r.doc_id, str(r.source)) for r in mixing.mixed_documents(docs).collect()) == copies


def test_plan_has_no_python(documents):
    plan = mixing.mix(documents((1, "x", "a")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
