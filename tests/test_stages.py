from datetime import date

from panelmint.config import Schedule, Settings
from panelmint.operators.tournament import tournament
from panelmint.plans.walk_forward import WalkForward


def test_months_in_stages_equal_the_walk_over_all_strong_pairs(ragged):
    """Several months at once, blocks of a few symbols."""
    settings = Settings(theta=0.1, min_obs=5, gram_block=2, block_cells=1500)
    walk = WalkForward(ragged[0], Schedule(date(2025, 2, 1), months=3, lookback_days=40), settings, "S00")
    pairs = walk.staged_edges()
    assert pairs.blocks > 1
    want = tournament(walk.strong_edges(), walk.candidates, settings, 3)
    keyed = lambda frame: {(r.month, r.symbol) for r in frame.collect()}
    got = keyed(walk.survivors())
    assert got == keyed(want) and len(got) < walk.candidates.count()
