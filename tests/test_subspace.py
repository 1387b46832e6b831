import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.operators.correlation import matrix_rows, pair_moments, principal_components
from panelmint.operators.subspace import leading_components
from tests.test_strong_pairs import panel


def tables(frame):
    out = {}
    for r in frame.collect():
        out.setdefault((r.month, r.component), [r.explained_variance, {}])[1][r.ord] = r.loading
    return out


@pytest.mark.parametrize("n, t, share", [(60, 120, 0.7), (40, 15, 1.0)])
def test_agrees_with_the_dense_decomposition(spark, n, t, share):
    """Fewer rows than columns as well: the basis then holds all that the returns span."""
    settings = Settings(components=5, chunk_bars=64, gram_block=32)
    chosen = panel(spark, n, t, 11, share).persist()
    rows = matrix_rows(chosen)
    want = tables(principal_components(pair_moments(chosen, settings), rows, settings))
    got = tables(leading_components(chosen, rows, settings))
    assert got.keys() == want.keys()
    for key, (share_, loading) in want.items():
        assert abs(got[key][0] - share_) < 1e-8
        a, b = (np.array([side[o] for o in sorted(loading)]) for side in (loading, got[key][1]))
        assert abs(abs(a @ b) - 1) < 1e-4 and abs(a[np.argmax(abs(a))]) > 0


def test_empty_and_one_row(spark):
    chosen = panel(spark, 4, 6, 2)
    assert leading_components(chosen.limit(0), matrix_rows(chosen.limit(0)), Settings()).count() == 0
    single = chosen.filter(F.col("timestamp") == chosen.agg(F.min("timestamp")).first()[0])
    assert leading_components(single, matrix_rows(single), Settings()).count() == 0


def test_many_symbols_go_by_iteration(spark):
    from panelmint.operators.correlation import fitting_components

    chosen = panel(spark, 30, 60, 4).persist()
    members = chosen.select("month", "ord", "size").distinct()

    def unwanted():
        raise AssertionError("no pair sums are needed")

    few = Settings(components=3, dense_symbols=10)
    many = Settings(components=3)
    got = tables(fitting_components(chosen, members, unwanted, few))
    want = tables(fitting_components(chosen, members, lambda: pair_moments(chosen, many), many))
    assert {k: round(v[0], 8) for k, v in got.items()} == {k: round(v[0], 8) for k, v in want.items()}
