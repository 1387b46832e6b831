from collections import Counter

import pytest

from panelmint.llm.mixing import poisson_mix


def test_rates_bring_sources_to_their_weights(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "concat('t', id) AS text", "CASE WHEN id < 4000 THEN 'big' WHEN id < 5950 THEN 'mid' END AS source", "id AS copy_of")
    out = poisson_mix(docs, weights={"big": 1.0, "mid": 1.0, None: 2.0}, total=8000)
    n = Counter(r.source for r in out.select("source").collect())
    assert n["big"] == pytest.approx(2000, rel=0.08) and n["mid"] == pytest.approx(2000, rel=0.08) and n[None] == pytest.approx(4000, rel=0.05)
    again = poisson_mix(docs.repartition(7), weights={"big": 1.0, "mid": 1.0, None: 2.0}, total=8000)
    key = lambda f: Counter((r.doc_id, r.copy) for r in f.select("doc_id", "copy").collect())
    assert key(out) == key(again)
    counts = Counter(r.doc_id for r in out.where("source = 'mid'").select("doc_id").collect())
    times = Counter(counts.values())
    assert times[1] / 1950 == pytest.approx(0.368, abs=0.04) and times[2] / 1950 == pytest.approx(0.19, abs=0.04)


def test_odd_rows_and_empty(odd, empty):
    out = poisson_mix(odd, total=60.0)
    assert out.columns == [*odd.columns, "copy"] and out.count() > 20
    assert {r.source for r in out.collect()} == {None, "a", "b", "c"}
    assert poisson_mix(odd, weights={}).count() == 0
    assert poisson_mix(empty).count() == 0
    with pytest.raises(ValueError):
        poisson_mix(odd, weights={"a": -1.0})
