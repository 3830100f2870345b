import re
from collections import defaultdict

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from metricloom.llm import exact_dedup, simhash
from metricloom.llm.graph import components
from tests.llm.conftest import clashing, unchanged


def groups_by_force(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    return groups


def test_text_groups_of_awkward_rows(awkward):
    for docs in (awkward, clashing(awkward)):
        rows = exact_dedup.text_groups(docs).collect()
        assert len(rows) == 10
        by_text = groups_by_force([(r.doc_id, r.text) for r in docs.collect()])
        assert sorted(r.group_size for r in rows) == sorted(len(g) for g in by_text.values() for _ in g)
        assert sum(r.kept for r in rows) == len(by_text)
        assert {r.keep_id for r in rows} == {min((i for i in g if i is not None), default=None) for g in by_text.values()}
        kept = exact_dedup.deduplicate(docs)
        assert kept.columns == docs.columns
        assert kept.count() == len(by_text)
    assert unchanged(kept)


def test_empty_table(awkward):
    empty = awkward.where("false")
    assert exact_dedup.text_groups(empty).count() == 0
    assert exact_dedup.deduplicate(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.deduplicate(empty).count() == 0


def test_hot_groups_are_dealt_in_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_COPIES", 5)
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 1)
    docs = documents(*[(i, f"text {i % 3}") for i in range(300)]).repartition(16)
    rows = exact_dedup.text_groups(docs).collect()
    assert all(r.keep_id == r.doc_id % 3 and r.group_size == 100 and r.kept == (r.doc_id < 3) for r in rows)
    assert len(rows) == 300


@given(st.lists(st.tuples(st.binary(max_size=6), st.integers(0, 50)), max_size=60))
@settings(max_examples=200, deadline=None)
def test_trie_keeps_the_smallest_id_and_counts(rows):
    trie, expected = exact_dedup.Trie(), {}
    for key, doc_id in rows:
        trie.insert(key, doc_id, 1, None)
        least, count = expected.get(key, (doc_id, 0))
        expected[key] = (min(least, doc_id), count + 1)
    assert {k: (i, n) for k, i, n, _ in trie.owners()} == expected


def fingerprint_by_force(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@given(st.text("abAÉ \t\n\x0b\x1cx", max_size=40))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == fingerprint_by_force(text)


def linked_by_force(values):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {frozenset(w for w in values if find(w) == find(v)) for v in values}


def test_links_lose_nothing_with_and_without_chunks(spark):
    random = np.random.default_rng(1)
    values = set()
    for seed in random.integers(0, 1 << 63, 12, dtype=np.uint64).tolist() + [0, (1 << 64) - 1]:
        for _ in range(25):
            flips = random.choice(64, random.integers(0, 7), replace=False)
            values.add(seed ^ sum(1 << int(b) for b in flips))
    signed = [(v - (1 << 64) if v >= 1 << 63 else v,) for v in values]
    for chunk in (4096, 4):
        edges = simhash.links(spark.createDataFrame(signed, "fp bigint"), chunk)
        roots = {r.node % (1 << 64): r.root for r in components(edges).collect()}
        groups = defaultdict(set)
        for v in values:
            groups[roots.get(v, ("alone", v))].add(v)
        assert {frozenset(g) for g in groups.values()} == linked_by_force(sorted(values))


def test_near_duplicates_of_awkward_rows(awkward):
    for docs in (awkward, clashing(awkward)):
        rows = simhash.near_duplicates(docs).collect()
        assert len(rows) == 10
        assert {r.fp % (1 << 64) for r in rows} == {fingerprint_by_force(r.text) for r in docs.collect()}
        empty = [r for r in rows if r.fp == 0]
        assert len(empty) == 4 and {r.component_id for r in empty} == {1}
        kept = simhash.deduplicate(docs)
        assert kept.columns == docs.columns
        assert kept.count() == len({r.root for r in rows})
    assert unchanged(kept)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(300)]
    roots = components(spark.createDataFrame(path + star + [(5, 5)], "a bigint, b bigint")).collect()
    assert len(roots) == 602
    assert len({r.root for r in roots if r.node <= 300}) == 1
    assert len({r.root for r in roots}) == 2
