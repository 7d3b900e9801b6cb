from __future__ import annotations

import numpy as np
import pytest

from inkprint.llm.embeddings import Quantised, linked, similar_vectors
from tests.llm.test_neardup import classes


def make(seed, n=80, dim=6):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        v = rng.normal(size=dim)
        if k and rng.random() < 0.6:
            old = rows[rng.integers(len(rows))][1]
            v = np.array(old) * rng.choice([1.0, 3.0]) + rng.choice([0, 0.2, 0.4]) * rng.normal(size=len(old))
        rows.append((k, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return rows


def brute(rows, threshold=0.93):
    def fine(v, label):
        return label is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
    good = {k: (np.array(v, dtype=float), label) for k, v, label in rows if fine(v, label)}
    pairs = [(a, b) for a in good for b in good if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0])
             and good[a][0] @ good[b][0] / np.linalg.norm(good[a][0]) / np.linalg.norm(good[b][0]) >= threshold]
    links = {k: 0 for k, _, _ in rows}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    return links, classes(pairs, links)


ODD = [(900, None, 1), (901, [0.0] * 6, 1), (902, [1.0, None, 0, 0, 0, 0], 1), (903, [float("nan")] * 6, 1),
       (904, [float("inf"), 0, 0, 0, 0, 0], 1), (905, [1.0, 2, 3, 4, 5, 6], None), (906, [], 1),
       (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1), (909, [1e-30] * 6, 2), (910, [1e30] * 6, 2)]


@pytest.mark.parametrize("block", [3, 2048])
def test_against_brute_force(spark, block):
    rows = make(block) + [(k, v if v is None else [x if x is None else float(x) for x in v], label) for k, v, label in ODD]
    links, component = brute(rows)
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = similar_vectors(d, block=block).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == links
    assert {r["vec_id"]: r["component_id"] for r in got} == component
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got) and len(got) == len(rows)


def test_many_equal_vectors(spark):
    d = spark.range(3000).selectExpr("id + 10 as vec_id", "array(1.0f, 2.0f) as embedding", "1 as label")
    got = similar_vectors(d).selectExpr("min(n_links)", "max(n_links)", "max(component_id)", "sum(int(kept))").first()
    assert tuple(got) == (2999, 2999, 10, 1)


def test_error_bound_holds_and_spares_work():
    rng = np.random.default_rng(3)
    for dim in (2, 64, 2500):
        q = Quantised(rng.normal(size=(60, dim)))
        exact = q.unit @ q.unit.T
        rough = q.products(slice(0, 60), q) * q.scale[:, None] * q.scale[None, :]
        bound = q.length[:, None] * q.error[None, :] + q.error[:, None] * (q.length + q.error)[None, :]
        assert (np.abs(exact - rough) <= bound).all() and bound.max() < 0.2
    assert not [x for x, _ in linked(q, q, 0.93, True) if len(x)]


def test_null_ids_repeated_ids_and_empty_tables(spark):
    d = spark.createDataFrame([(None, [1.0], 1, 0), (5, [1.0], 1, 0), (5, [1.0], 1, 0), (6, [2.0], 1, 0)],
                              "vec_id long, embedding array<float>, label int, links int")
    got = {r["vec_id"]: (r["component_id"], r["kept"]) for r in similar_vectors(d).collect()}
    assert got == {None: (None, True), 5: (5, True), 6: (5, False)}
    assert similar_vectors(d.limit(0)).count() == 0
