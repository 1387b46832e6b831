import re
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.operators import correlation as corr
from panelmint.operators.blocks import SIDES, width_for
from panelmint.operators.tournament import contests, tournament
from panelmint.plans.static_models import StaticModels
from tests.conftest import BAR, START

# Blocks of some ten symbols.
SMALL = Settings(theta=0.5, min_obs=5, gram_block=2, block_cells=600)


@pytest.fixture(scope="module")
def families(make_panel):
    """Families of symbols that follow one series each, with gaps; some symbols are too short for a Sharpe ratio or never vary."""
    rng = np.random.default_rng(11)
    rows = []
    for family in range(6):
        steps = rng.normal(0, 0.02, 60)
        for copy in range(9):
            own = steps + rng.normal(0, (0.0, 0.004, 0.03)[copy % 3], 60)
            price = 100 * np.exp(np.cumsum(own))
            kept = rng.random(60) < 0.9
            rows += [(f"F{family}C{copy}", START + k * BAR, float(price[k])) for k in np.flatnonzero(kept)]
    rows += [(f"SHORT{s}", START + (s + k) * BAR, float(5 + k)) for s in range(3) for k in range(4)]
    rows += [(f"FLAT{s}", START + k * BAR, 3.0) for s in range(2) for k in range(30)]
    return make_panel(rows)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_streamed_to_the_named_edges(families):
    """A row for each pair passes no shuffle, no sort and no cache."""
    model = StaticModels(families, SMALL)
    text = plan(model.named_edges())
    above, product, _ = text.partition("CartesianProduct")
    assert product and not re.search("Exchange|SortMergeJoin|Sort |InMemory|HashAggregate", above)
    edges = model.named_edges()
    n = model.universe.count()
    assert edges.count() == n * (n - 1) // 2 == edges.select("symbol_i", "symbol_j").distinct().count()


def test_summary_streams_the_pairs(families):
    """Only one row per task of the summary is shuffled, and no pair is kept."""
    model = StaticModels(families, SMALL)
    summary = corr.matrix_summary(model.edges())
    above, product, _ = plan(summary).partition("CartesianProduct")
    assert product and above.count("Exchange") == above.count("Exchange SinglePartition") == 1
    assert "moments" not in model.__dict__
    rho = [r.rho for r in model.edges().collect()]
    row, defined = summary.first(), [v for v in rho if v is not None]
    assert (row.pairs, row.defined_pairs) == (len(rho), len(defined)) and row.max_rho == pytest.approx(max(defined))


def test_cells_are_written_once_whatever_the_blocks(families):
    model = StaticModels(families, SMALL)
    moments = corr.pair_moments(model.chosen, SMALL)
    wide = corr.pair_moments(model.chosen, replace(SMALL, block_cells=10**6, gram_block=64))
    keyed = lambda frame: {(r.i, r.j): tuple(r[3:]) for r in frame.collect()}
    got, want = keyed(moments), keyed(wide)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_block_width_follows_the_length_of_the_matrix(spark):
    rows = spark.createDataFrame([(0, 100), (1, 20)], "month int, t long")
    wide = Settings(block_cells=120_000)
    assert width_for(rows, 64, wide, 4) == 4 and width_for(rows, 64 * SIDES, wide, 4) == 64
    assert width_for(rows, 10**9, wide, 4) == 1000 and width_for(rows, 10**9, wide, 10**9) == 1000
    assert width_for(rows, 10, Settings(block_cells=7), 4) == 1 and width_for(rows.limit(0), 0, wide, 4) == 4


def sequential(rho, members, theta):
    """The walk over the whole matrix in matrix order."""
    sharpe = {m.ord: m.sharpe for m in members}
    dropped = set()
    for i, j in sorted(rho):
        if rho[i, j] is None or abs(rho[i, j]) <= theta or sharpe[i] is None or sharpe[j] is None or {i, j} & dropped:
            continue
        dropped.add(i if sharpe[i] < sharpe[j] else j)
    return {m.symbol for m in members} - {m.symbol for m in members if m.ord in dropped}


@pytest.mark.parametrize("cells", [300, 10**6])
@pytest.mark.parametrize("theta", [0.2, 0.5, 0.95])
def test_stages_equal_the_sequential_walk(families, cells, theta):
    settings = replace(SMALL, block_cells=cells, theta=theta)
    model = StaticModels(families, settings)
    members = model.universe.join(model.metrics, ["month", "symbol"], "left").collect()
    rho = {(r.i, r.j): r.rho for r in model.edges().collect()}
    assert {r.symbol for r in model.survivors().collect()} == sequential(rho, members, theta)


def test_look_alikes_do_not_multiply_the_pairs(make_panel):
    """Of a family of look-alikes at most the survivors of a block meet the others: pairs follow the symbols, not their squares."""
    rng = np.random.default_rng(2)
    price = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, 30)))
    written = {}
    for copies in (20, 40):
        panel = make_panel([(f"S{c:03d}", START + k * BAR, float(price[k])) for c in range(copies) for k in range(30)])
        model = StaticModels(panel, replace(SMALL, block_cells=29 * 8))
        members = model.universe.join(model.metrics, ["month", "symbol"], "left")
        gone = members.select("month", "ord").limit(0)
        written[copies] = 0
        for stage in model.staged_edges(members).stages():
            heads, lost = stage.inside(gone)
            gone = gone.unionByName(lost)
            written[copies] += stage.beyond(heads, gone).count()
            gone = gone.unionByName(stage.beyond(heads, gone).select("month", F.col("j").alias("ord")))
        assert [r.symbol for r in model.survivors().collect()] == ["S000"]
        assert 0 < written[copies] < copies


def test_basket_of_stages_equals_that_of_all_strong_pairs(families):
    """And the rounds of the stages see fewer pairs than there are strong ones."""
    model = StaticModels(families, replace(SMALL, top_n=5))
    members = model.universe.join(model.metrics, ["month", "symbol"], "left")
    whole = tournament(model.strong_edges(), members, model.settings)
    keyed = lambda frame: {r.symbol: r.weight for r in frame.collect()}
    want, got = keyed(model._basket(whole)), keyed(model.smart_basket())
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    first = next(iter(model.staged_edges(members).stages()))
    heads, lost = first.inside(members.select("month", "ord").limit(0))
    assert lost.count() and first.beyond(heads, lost).count() < contests(model.strong_edges(), members, model.settings).count()
