from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from panelmint.config import Schedule, Settings
from panelmint.operators import correlation as corr
from panelmint.operators import returns as rets
from panelmint.operators.selection import as_members, universe_cap
from panelmint.plans.static_models import StaticModels

from tests.conftest import BAR, START

# Blocks of 4 symbols and chunks of 50 bars: the 12 symbols need 3 x 3 block pairs.
SETTINGS = Settings(max_symbols=12, gram_block=4, chunk_bars=50, components=4)


@pytest.fixture(scope="module")
def models(ragged):
    return StaticModels(ragged[0], SETTINGS)


@pytest.fixture(scope="module")
def wide(models):
    """The pivoted matrix and its symbols in matrix order."""
    order = [r["symbol"] for r in models.universe.orderBy("ord").collect()]
    returns = rets.log_returns(models.panel, SETTINGS)
    return rets.wide_returns(returns, order), order


def full_matrix(edges, n):
    out = np.eye(n)
    for r in edges.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["rho"]
    return out


def test_blocked_gram_equals_mllib(models, wide):
    frame, order = wide
    vectors = VectorAssembler(inputCols=order, outputCol="v").transform(frame)
    want = Correlation.corr(vectors, "v").head()[0].toArray()
    assert full_matrix(models.edges(), len(order)) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("block", [1, 5, 12, 256])
def test_block_width_does_not_matter(models, wide, block):
    moments = corr.pair_moments(models.chosen, replace(SETTINGS, gram_block=block))
    got = corr.correlations(moments, corr.matrix_rows(models.chosen))
    n = len(wide[1])
    assert got.count() == n * (n - 1) // 2
    assert full_matrix(got, n) == pytest.approx(full_matrix(models.edges(), n), abs=1e-12)


def test_components_equal_mllib(models, wide):
    frame, order = wide
    vectors = VectorAssembler(inputCols=order, outputCol="v").transform(frame)
    fitted = PCA(k=4, inputCol="v", outputCol="p").fit(vectors)
    loadings = models.components().toPandas()
    shares = loadings.groupby("component")["explained_variance"].first().to_numpy()
    assert shares == pytest.approx(fitted.explainedVariance.toArray(), abs=1e-9)
    got = loadings.pivot(index="ord", columns="component", values="loading").to_numpy()
    assert np.abs(got) == pytest.approx(np.abs(fitted.pc.toArray()), abs=1e-6)
    assert got.T @ got == pytest.approx(np.eye(4), abs=1e-9)
    assert (np.diff(shares) <= 1e-12).all()
    # Scores are the matrix times the loadings.
    scores = models.scores().filter("component = 1").orderBy("timestamp").toPandas()
    dense = frame.orderBy("timestamp").toPandas()
    assert scores["score"].to_numpy() == pytest.approx(dense[order].to_numpy() @ got[:, 0], abs=1e-9)


def test_variance_target_is_marked_once(models):
    table = corr.explained_variance(models.components(), replace(SETTINGS, variance_target=0.4)).orderBy("component").toPandas()
    assert table["reaches_target"].sum() == 1
    row = table[table["reaches_target"]].iloc[0]
    assert row["cumulative_variance"] >= 0.4 and row["cumulative_variance"] - row["explained_variance"] < 0.4
    never = corr.explained_variance(models.components(), replace(SETTINGS, variance_target=1.1))
    assert not never.filter("reaches_target").count()


def test_flat_symbol_has_no_correlation(make_panel):
    rows = [("D", START + k * BAR, 5.0) for k in range(6)]
    rows += [("A", START + k * BAR, 5.0 + k % 2) for k in range(6)]
    edge = StaticModels(make_panel(rows), SETTINGS).edges().collect()
    assert [r["rho"] for r in edge] == [None]


def test_symbols_that_never_overlap_have_a_pair(make_panel):
    rng = np.random.default_rng(1)
    rows = [("A", START + k * BAR, float(p)) for k, p in enumerate(rng.uniform(1, 2, 20))]
    rows += [("B", START + (100 + k) * BAR, float(p)) for k, p in enumerate(rng.uniform(1, 2, 20))]
    (edge,) = StaticModels(make_panel(rows), SETTINGS).edges().collect()
    a = np.diff(np.log([p for s, _, p in rows if s == "A"]))
    b = np.diff(np.log([p for s, _, p in rows if s == "B"]))
    x, y = np.concatenate([a, np.zeros(19)]), np.concatenate([np.zeros(19), b])
    assert edge["rho"] == pytest.approx(np.corrcoef(x, y)[0, 1])


def test_row_count_without_returns_equals_row_count_of_returns(ragged, make_panel):
    # A lone first bar makes a timestamp that carries no return.
    rows = ragged[1] + [("LONE", START + k * BAR, 1.0) for k in (460, 470)]
    schedule = Schedule(date(2025, 2, 1), months=4, lookback_days=40)
    panel = make_panel(rows)
    bars = rets.lookback_bars(panel, schedule)
    firsts = bars.groupBy("month", "symbol").agg(F.min("timestamp").alias("first_bar"))
    got = {r["month"]: r["t"] for r in corr.rows_with_any_return(bars, firsts).collect()}
    want = {r["month"]: r["t"] for r in corr.matrix_rows(rets.windowed_returns(panel, schedule, SETTINGS)).collect()}
    assert got == want and len(want) > 1


def test_universe_is_ordered_by_bars_then_symbol(make_panel):
    rows = [("B", START, 1.0), ("A", START, 1.0), ("C", START, 1.0), ("C", START + BAR, 1.0)]
    members = as_members(universe_cap(make_panel(rows), Settings(max_symbols=2))).orderBy("ord").collect()
    assert [(m["symbol"], m["ord"], m["size"]) for m in members] == [("C", 0, 2), ("A", 1, 2)]
