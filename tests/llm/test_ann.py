import numpy as np
import pytest

from metricloom.llm import ann
from tests.llm.conftest import clashing

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def by_force(rows, neighbours=20, divide=20):
    usable = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and v.any()]
    sizes = [len(v) for _, v in usable]
    usual = max(set(sizes), key=lambda s: (sizes.count(s), -s)) if sizes else 0
    usable = [(i, v) for i, v in usable if len(v) == usual]
    out = {}
    for q, v in usable:
        if q % divide == 0:
            near = sorted((-float((v * w).sum()), i) for i, w in usable if i != q)[:neighbours]
            out[q] = [(i, -s) for s, i in near]
    return out


def check(df, rows):
    found = {}
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    expected = {q: n for q, n in by_force(rows).items() if n}
    assert found.keys() == expected.keys()
    for q, near in expected.items():
        assert [i for i, _ in found[q]] == [i for i, _ in near]
        assert np.allclose([s for _, s in found[q]], [s for _, s in near], rtol=0, atol=1e-12)


@pytest.mark.parametrize("clustered", [False, True])
def test_nearest_are_those_by_force(spark, monkeypatch, clustered):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(3)
    v = rng.standard_normal((800, 16)).astype(np.float32)
    if clustered:
        v = (rng.standard_normal((10, 16))[rng.integers(0, 10, 800)] * 5 + v / 10).astype(np.float32)
    v[100:400] = v[100]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    check(spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA), rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 2.0]), (20, [1.0, 0.0]), (40, None), (41, []), (42, [0.0, 0.0]), (43, [nan, 1.0]), (44, [inf, 1.0])]
    rows += [(45, [None, 1.0]), (46, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (60, [-1.0, 0.5]), (61, [1.0, 0.0])]
    df = spark.createDataFrame([(i, x, None) for i, x in rows], SCHEMA)
    for vectors in (df, clashing(df)):
        check(vectors, rows)
    assert ann.nearest(df.where("false")).count() == 0
    assert ann.nearest(df.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("kind", ["binary", "one-hot", "quantised"])
def test_ties_go_to_the_smaller_id(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(9)
    if kind == "one-hot":
        v = np.eye(220)
    elif kind == "binary":
        v = np.array([[1.0, *(float(b) for b in f"{i:08b}")] for i in range(220)])
        v[0, 1:] = 0
    else:
        v = rng.integers(-1, 2, (220, 6)) + np.array([3.0, 0, 0, 0, 0, 0])
    rows = [(i * 5 if kind == "binary" else i, x.tolist()) for i, x in enumerate(v)]
    rng.shuffle(rows)
    check(spark.createDataFrame([(int(i), x, 0) for i, x in rows], SCHEMA), [(int(i), x) for i, x in rows])


def test_hilbert_curve_goes_from_neighbour_to_neighbour():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.array(np.meshgrid(*[np.arange(1 << bits)] * d)).reshape(d, -1).T
        keys = ann.hilbert_keys(points, bits)
        order = points[np.argsort(keys)]
        assert sorted(keys.tolist()) == list(range(1 << d * bits))
        assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()
