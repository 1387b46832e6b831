import random

import pytest
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.operators import tournament as t

SETTINGS = Settings(theta=0.85)


def sequential(pairs):
    dropped = set()
    for i, j, loser in sorted(pairs):
        if i not in dropped and j not in dropped:
            dropped.add(loser)
    return dropped


@pytest.fixture(scope="module")
def graphs():
    rng = random.Random(3)
    out = {}
    for month in range(1, 13):
        n = rng.randint(2, 12)
        pairs = [(i, j) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]
        out[month] = [(i, j, rng.choice((i, j))) for i, j in pairs]
    out[13] = [(i, j, j) for i in range(6) for j in range(i + 1, 6)]  # a clique in Sharpe order
    return out


def test_rounds_equal_the_sequential_walk(spark, graphs):
    rows = [(m, *p) for m, pairs in graphs.items() for p in pairs]
    got = {m: set() for m in graphs}
    for r in t.losers(spark.createDataFrame(rows, "month int, i int, j int, loser int")).collect():
        got[r["month"]].add(r["ord"])
    assert got == {m: sequential(pairs) for m, pairs in graphs.items()}


@pytest.mark.parametrize("ordered, most", [(True, 1), (False, 12)])
def test_a_clique_takes_few_rounds(spark, monkeypatch, ordered, most):
    n = 200
    rank = list(range(n)) if ordered else random.Random(5).sample(range(n), n)
    pairs = spark.range(n).selectExpr("CAST(id AS INT) AS i").join(spark.range(n).selectExpr("CAST(id AS INT) AS j"), F.col("i") < F.col("j"))
    order = F.array(*[F.lit(r) for r in rank])
    better = order[F.col("i")] < order[F.col("j")]
    contests = pairs.select(F.lit(0).alias("month"), "i", "j", F.when(better, F.col("j")).otherwise(F.col("i")).alias("loser"))
    rounds = []
    empty = type(contests).isEmpty
    monkeypatch.setattr(type(contests), "isEmpty", lambda self: rounds.append(1) or empty(self))
    assert t.losers(contests).count() == n - 1
    assert len(rounds) - 1 <= most


def survivors(spark, sharpes, edges, settings=SETTINGS):
    members = spark.createDataFrame(
        [(0, f"S{k}", k, len(sharpes), s) for k, s in enumerate(sharpes)],
        "month int, symbol string, ord int, size int, sharpe double",
    )
    frame = spark.createDataFrame([(0, i, j, rho) for i, j, rho in edges], "month int, i int, j int, rho double")
    return sorted(r["ord"] for r in t.tournament(frame, members, settings).collect())


def test_chain_spares_the_symbol_behind_a_loser(spark):
    assert survivors(spark, [3.0, 2.0, 1.0], [(0, 1, 0.9), (1, 2, 0.9)]) == [0, 2]


def test_tie_drops_the_later_symbol(spark):
    assert survivors(spark, [1.0, 1.0], [(0, 1, -0.9)]) == [0]


def test_lower_sharpe_loses_wherever_it_stands(spark):
    assert survivors(spark, [1.0, 2.0], [(0, 1, 0.9)]) == [1]


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_missing_sharpe_skips_the_pair(spark, missing):
    assert survivors(spark, [1.0, missing], [(0, 1, 0.99)]) == [0, 1]


def test_threshold_is_strict(spark):
    assert survivors(spark, [1.0, 2.0], [(0, 1, 0.85)]) == [0, 1]
