import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import connect, difference
from metricloom.llm import bpe, exact_dedup, mixing, simhash, toxicity
from metricloom.llm.common import table
from metricloom.llm.queries import QUERIES, SQL, VOCABULARY
from tests.conftest import SMALL


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, connect(SMALL), name, SMALL) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_a_row_for_each_document(spark, name):
    rows = QUERIES[name](spark, SMALL)
    if name not in ("op1_secret_scan", "op8_ann", "op13_divergence"):
        ids = [r.doc_id for r in rows.select("doc_id").collect()]
        assert sorted(ids) == sorted(r.doc_id for r in table(spark, SMALL, "documents").select("doc_id").collect())
    else:
        assert rows.count() > 0


def test_everything_is_registered():
    assert {*QUERIES, "pipeline"} <= queries().keys()
    assert SQL.keys() <= oracle_sql().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_does_what_its_operators_say(spark):
    docs = table(spark, SMALL, "documents")
    columns, bad = docs.columns, {r.doc_id for r in toxicity.toxicity_scores(docs, table(spark, SMALL, "labels")).where("predicted = 1").collect()}
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SMALL)
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad
    single = stages["exact_dedup"](spark, clean, SMALL)
    assert single.columns == columns and {r.doc_id for r in single.collect()} == {r.doc_id for r in exact_dedup.text_groups(clean).where("kept").collect()}
    apart = stages["simhash_dedup"](spark, single, SMALL)
    assert apart.columns == columns and {r.doc_id for r in apart.collect()} == {r.component_id for r in simhash.near_duplicates(single).collect()}
    mixed = stages["mixing"](spark, apart, SMALL)
    copies = sorted(r.doc_id for r in mixing.mix(apart).collect() for _ in range(r.copies))
    assert mixed.columns == columns and sorted(r.doc_id for r in mixed.collect()) == copies
    automaton = bpe.load_automaton(VOCABULARY)
    text = {r.doc_id: r.text for r in docs.collect()}
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in out) == copies
    assert all(list(r.ids) == automaton.encode(text[r.doc_id]) and r.n_tokens == len(r.ids) for r in out)


def test_pipeline_of_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, SMALL, name).where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
