from __future__ import annotations

from math import log

import pytest

from inkprint.llm.mixing import NO_SOURCE, mix, weigh

SIZES = {"a": 1000, "b": 100, "c": 10}


def sources(spark, sizes=SIZES):
    return spark.createDataFrame(list(sizes.items()), "source string, tokens long")


def weights(spark, **options):
    m = weigh(sources(spark), **options)
    return m, {r["source"]: (r["weight"], r["allowance"]) for r in m.sources.collect()}


def test_target_entropy(spark):
    for target in (0.2, 0.6, 1.0):
        m, w = weights(spark, entropy=target)
        assert -sum(x * log(x) for x, _ in w.values()) == pytest.approx(target, abs=1e-6)
        assert sum(x for x, _ in w.values()) == pytest.approx(1)
    m, w = weights(spark, entropy=9.0)
    assert m.exponent == pytest.approx(0, abs=1e-9) and w["c"][0] == pytest.approx(1 / 3)


def test_repetition_limit(spark):
    m, w = weights(spark, max_repeats=3.0)
    assert max(w[s][0] * 1110 / n for s, n in SIZES.items()) == pytest.approx(3.0, abs=1e-6) and 0 < m.exponent < 1
    m, _ = weights(spark, max_repeats=1000.0)
    assert m.exponent == pytest.approx(0, abs=1e-9)
    m, w = weights(spark, max_repeats=2.0, budget=5000)
    assert m.exponent == 1.0 and w["a"][1] == round(5000 * 1000 / 1110)
    with pytest.raises(ValueError):
        weights(spark)


def docs(spark):
    rows = [(k, "big", "w " * (1 + k % 9)) for k in range(900)] + [(1000 + k, "small", "w\tv\n" * 5) for k in range(20)]
    rows += [(2000 + k, None, "x y z") for k in range(10)] + [(3000, "big", None), (3001, "big", "  "), (3002, "nothing", "")]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_budgets_are_met_to_a_document(spark):
    d = docs(spark)
    out = mix(d, max_repeats=3.5, block_tokens=64).collect()
    total = {"big": sum(1 + k % 9 for k in range(900)), "small": 200, NO_SOURCE: 30}
    budgets = {r["source"]: r["allowance"] for r in weigh(sources(spark, total), max_repeats=3.5).sources.collect()}
    for name, budget in budgets.items():
        drawn = sum(r["n_tokens"] for r in out if r["source"] == name)
        assert 0 <= drawn - budget < 10
        times = {}
        for r in out:
            if r["source"] == name:
                times.setdefault(r["doc_id"], set()).add(r["pass"])
        whole = budget // total[name]
        assert all(p >= set(range(whole)) for p in times.values())
    assert not {3000, 3001, 3002} & {r["doc_id"] for r in out}
    assert len(out) == len({(r["doc_id"], r["pass"]) for r in out})


def test_passes_are_permuted_differently_and_repeat(spark):
    d = docs(spark)
    order = lambda rows, p: {r["doc_id"]: r["block_rank"] for r in rows if r["pass"] == p and r["source"] == "small"}
    one = mix(d, budget=60_000, block_tokens=20, max_repeats=100.0).collect()
    assert order(one, 0) != order(one, 1) and set(order(one, 0)) == set(order(one, 1))
    assert sorted(map(str, one)) == sorted(map(str, mix(d.repartition(7), budget=60_000, block_tokens=20, max_repeats=100.0).collect()))


def test_empty_and_clashing(spark):
    d = docs(spark).selectExpr("*", "1 as tokens", "'x' as block")
    assert mix(d.limit(0)).count() == 0
    assert mix(d.where("doc_id >= 3000")).count() == 0
    assert set(mix(d).columns) == {"doc_id", "source", "pass", "block_rank", "n_tokens"}
