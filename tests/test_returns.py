from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from panelmint.config import Schedule, Settings
from panelmint.operators import features, metrics, returns

from tests.conftest import BAR, START


def brute_returns(rows):
    frame = pd.DataFrame(rows, columns=["symbol", "timestamp", "close"]).sort_values(["symbol", "timestamp"])
    frame["ret"] = np.log(frame["close"] / frame.groupby("symbol")["close"].shift(1))
    return frame


def keyed(frame, columns):
    return frame.sort_values(["symbol", "timestamp"]).set_index(["symbol", "timestamp"])[columns]


@pytest.mark.parametrize("chunk_bars", [1, 3, 32, 512])
def test_returns_cross_chunks(ragged, chunk_bars):
    panel, rows = ragged
    got = keyed(returns.log_returns(panel, Settings(chunk_bars=chunk_bars)).toPandas(), ["ret"])
    want = keyed(brute_returns(rows).dropna(), ["ret"])
    pd.testing.assert_frame_equal(got, want, check_index_type=False)


def test_gap_return_spans_the_gap(make_panel):
    panel = make_panel([("A", START, 100.0), ("A", START + BAR, 110.0), ("A", START + 3 * BAR, 121.0)])
    got = sorted(r["ret"] for r in returns.log_returns(panel, Settings()).collect())
    assert got == pytest.approx([np.log(1.1)] * 2)


@pytest.mark.parametrize("chunk_bars", [1, 512])
def test_a_non_positive_close_voids_both_returns(make_panel, chunk_bars):
    prices = [100.0, 110.0, 0.0, 120.0, -5.0, -6.0, 60.0, 66.0]
    panel = make_panel([("A", START + k * BAR, p) for k, p in enumerate(prices)])
    got = [(r["timestamp"], r["ret"]) for r in returns.log_returns(panel, Settings(chunk_bars=chunk_bars)).collect()]
    assert sorted(got) == [(START + BAR, pytest.approx(np.log(1.1))), (START + 7 * BAR, pytest.approx(np.log(1.1)))]


@pytest.mark.parametrize("chunk_bars", [32, 64, 512])
def test_features_match_a_whole_history_window(ragged, chunk_bars):
    panel, rows = ragged
    frame = brute_returns(rows)
    by = frame.groupby("symbol")
    for k in (1, 2, 3):
        frame[f"ret_lag{k}"] = by["ret"].shift(k)
    frame["ma7"] = by["close"].transform(lambda s: s.rolling(7, min_periods=1).mean())
    frame["ma30"] = by["close"].transform(lambda s: s.rolling(30, min_periods=1).mean())
    frame["ma_ratio"] = frame["ma7"] / frame["ma30"]
    frame["volatility_7d"] = by["ret"].transform(lambda s: s.rolling(7, min_periods=2).std())
    frame["target"] = by["ret"].shift(-1)
    columns = [*features.FEATURES, "ma7", "ma30", "target"]
    got = features.rolling_features(panel, Settings(chunk_bars=chunk_bars)).toPandas()
    pd.testing.assert_frame_equal(keyed(got, columns), keyed(frame, columns), check_index_type=False, atol=1e-12)
    full = features.forecast_frame(panel, Settings(chunk_bars=chunk_bars)).count()
    assert full == len(frame.dropna())


def test_lookback_is_half_open_and_restarts_the_lag(make_panel):
    schedule = Schedule(date(2025, 4, 1), months=2, lookback_days=90)
    begin = datetime(2025, 4, 1) - timedelta(days=90)
    panel = make_panel(
        [("A", begin - BAR, 90.0), ("A", begin, 100.0), ("A", begin + BAR, 110.0), ("A", datetime(2025, 4, 1), 120.0)]
    )
    bars = returns.lookback_bars(panel, schedule)
    april = {r["timestamp"] for r in bars.collect() if r["month"] == 1}
    assert april == {begin, begin + BAR}
    got = {(r["month"], r["timestamp"]) for r in returns.windowed_returns(panel, schedule, Settings()).collect()}
    # The bar before the window gives no return at its start; in May's window 1 April is the first bar.
    assert got == {(1, begin + BAR)}


@pytest.mark.parametrize("chunk_bars", [5, 512])
def test_window_returns_equal_a_lag_per_window(ragged, chunk_bars):
    panel, rows = ragged
    schedule = Schedule(date(2025, 1, 20), months=4, lookback_days=25)
    want = {}
    for month, hold in enumerate(schedule.hold_starts, start=1):
        begin = hold - timedelta(days=25)
        inside = brute_returns([r for r in rows if begin <= r[1] < hold]).dropna()
        want.update({(month, r.symbol, r.timestamp.to_pydatetime()): r.ret for r in inside.itertuples()})
    got = returns.windowed_returns(panel, schedule, Settings(chunk_bars=chunk_bars)).collect()
    assert {(r["month"], r["symbol"], r["timestamp"]): r["ret"] for r in got} == pytest.approx(want)


def test_every_lookback_month_is_found(ragged):
    panel, rows = ragged
    schedule = Schedule(date(2025, 1, 1), months=6, lookback_days=90)
    got = returns.lookback_bars(panel, schedule).groupBy("month").count().collect()
    stamps = [t for _, t, _ in rows]
    want = {}
    for month, hold in enumerate(schedule.hold_starts, start=1):
        n = sum(hold - timedelta(days=90) <= t < hold for t in stamps)
        if n:
            want[month] = n
    assert {r["month"]: r["count"] for r in got} == want


def test_min_obs_is_strict_and_flat_prices_have_no_sharpe(make_panel):
    rows = [("A", START + k * BAR, 100.0 + k) for k in range(4)]
    rows += [("D", START + k * BAR, 5.0) for k in range(5)]
    settings = Settings(min_obs=3)
    got = metrics.asset_metrics(returns.log_returns(make_panel(rows), settings), settings).collect()
    assert [(r["symbol"], r["annual_vol"], r["sharpe"]) for r in got] == [("D", 0.0, None)]


def test_exact_lookup_never_takes_a_near_bar(make_panel):
    panel = make_panel([("A", START, 1.0), ("A", START + timedelta(minutes=1), 2.0)])
    assert [r["close"] for r in returns.bars_at(panel, [START]).collect()] == [1.0]


def test_wide_matrix_is_zero_filled(make_panel):
    panel = make_panel([("A", START, 1.0), ("A", START + BAR, 2.0), ("B", START + BAR, 1.0), ("B", START + 2 * BAR, 3.0)])
    wide = returns.wide_returns(returns.log_returns(panel, Settings()), ["A", "B"]).orderBy("timestamp").collect()
    assert [(r["A"], r["B"]) for r in wide] == [(pytest.approx(np.log(2)), 0.0), (0.0, pytest.approx(np.log(3)))]


def test_sparse_rows_are_the_wide_matrix(ragged):
    panel, _ = ragged
    rets = returns.log_returns(panel, Settings())
    numbers = returns.symbol_numbers(rets)
    order = [r["symbol"] for r in sorted(numbers.collect(), key=lambda r: r["number"])]
    assert order == sorted(order) and [r["number"] for r in sorted(numbers.collect())] == list(range(len(order)))
    want = {r["timestamp"]: [r[c] for c in order] for r in returns.wide_returns(rets, order).collect()}
    for block in (5, 4096):
        got = {}
        for r in returns.sparse_returns(rets, numbers, block).collect():
            assert r["indices"] == sorted(r["indices"]) and len(r["values"]) == len(r["indices"]) <= block
            row = got.setdefault(r["timestamp"], [0.0] * len(order))
            for k, v in zip(r["indices"], r["values"]):
                row[r["block"] * block + k] = v
        assert got == want


def test_sparse_rows_of_an_empty_panel(make_panel):
    rets = returns.log_returns(make_panel([]), Settings())
    assert returns.sparse_returns(rets, returns.symbol_numbers(rets)).count() == 0
