from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.functions.kernels import block_pairs
from panelmint.operators import strong_pairs as sp
from panelmint.operators.correlation import correlations, matrix_rows, pair_moments
from tests.conftest import START

BAR = timedelta(hours=4)


def panel(spark, n, t, seed, share=1.0, families=4):
    """Returns of n symbols: some follow a common factor closely, others are noise with heavy tails; month 0 and a smaller month 1."""
    rng = np.random.default_rng(seed)
    factors = rng.normal(size=(families, t))
    rows = []
    for month, count in ((0, n), (1, max(2, n // 3))):
        for i in range(count):
            noise = rng.standard_t(3, size=t)
            x = factors[i % families] + 0.15 * noise if i % 3 == 0 else noise
            if i == 5:
                x = np.full(t, 0.25) * (rng.random(t) < 2)  # does not vary
            present = rng.random(t) < share
            rows += [(month, f"S{i}", i, count, START + k * BAR, float(x[k])) for k in np.flatnonzero(present)]
    return spark.createDataFrame(rows, "month int, symbol string, ord int, size int, timestamp timestamp_ntz, ret double")


@pytest.mark.parametrize("theta, share", [(0.85, 1.0), (0.65, 0.8), (0.3, 0.6)])
def test_equals_the_filtered_matrix(spark, theta, share):
    settings = Settings(theta=theta, chunk_bars=32, gram_block=4)
    chosen = panel(spark, 70, 150, 3, share).persist()
    rows = matrix_rows(chosen)
    want = {(r.month, r.i, r.j): r.rho for r in correlations(pair_moments(chosen, settings), rows).filter(F.abs("rho") > theta).collect()}
    got = {(r.month, r.i, r.j): r.rho for r in sp.strong_pairs(chosen, rows, settings).collect()}
    assert want and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_the_screen_leaves_most_blocks_out(spark):
    settings = Settings(theta=0.85, chunk_bars=64, gram_block=4)
    chosen = panel(spark, 160, 600, 5, families=2).filter("month = 0").persist()
    # Related symbols are few here: all but those of one family are noise.
    chosen = chosen.filter("ord % 3 <> 0 or ord < 24").persist()
    rows = matrix_rows(chosen)
    series = sp.series_table(chosen, rows, settings).persist()
    share = sp.screen_share(settings.theta)
    met = sp._met(sp._packed(chosen, series, settings, share), series, None)
    left = met.mapInPandas(block_pairs(settings.theta, screen=True), "month int, left int, right int").count()
    blocks = series.agg(F.max("block")).first()[0] + 1
    assert 0 < left <= blocks * (blocks + 1) / 2 / 2
    strong = {(r.i, r.j) for r in sp.strong_pairs(chosen, rows, settings).collect()}
    want = correlations(pair_moments(chosen, settings), rows).filter(F.abs("rho") > settings.theta)
    assert strong == {(r.i, r.j) for r in want.collect()}


def test_empty(spark):
    chosen = panel(spark, 3, 4, 1).limit(0)
    assert sp.strong_pairs(chosen, matrix_rows(chosen), Settings()).count() == 0
