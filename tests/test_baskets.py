import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmint.config import Schedule, Settings
from panelmint.operators import holding, performance, selection, weights
from panelmint.sources.exports import weights_from_rows

SETTINGS = Settings(top_n=4)
SCHEDULE = Schedule(date(2025, 1, 1), months=2)
JAN, FEB, MAR = datetime(2025, 1, 1), datetime(2025, 2, 1), datetime(2025, 3, 1)
BAR = timedelta(hours=4)


def take_turns(groups, n):
    """Reference walk: one from each group in order, again and again."""
    queues = {g: sorted(items, key=lambda x: (-x[1], x[0])) for g, items in groups.items()}
    chosen = []
    while len(chosen) < n and any(queues.values()):
        for g in sorted(queues):
            if queues[g] and len(chosen) < n:
                chosen.append(queues[g].pop(0)[0])
    return chosen


def test_round_robin_equals_taking_turns(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for month in range(1, 9):
        groups = {g: [(f"{month}-{g}-{k}", rng.random()) for k in range(rng.randint(0, 6))] for g in range(5)}
        rows += [(month, s, g, sh) for g, items in groups.items() for s, sh in items]
        want[month] = take_turns(groups, 7)
    frame = spark.createDataFrame(rows, "month int, symbol string, cluster int, sharpe double")
    got = {}
    for r in selection.round_robin(frame, 7).orderBy("month", "rank").collect():
        got.setdefault(r["month"], []).append(r["symbol"])
    assert got == {m: w for m, w in want.items() if w}


def test_large_selections_are_exact(spark):
    frame = spark.range(5000).select(
        (F.col("id") % 2).cast("int").alias("month"), F.concat(F.lit("S"), "id").alias("symbol"), (F.col("id") % 97).alias("score")
    )
    order = [F.desc("score"), F.asc("symbol")]
    got = selection.ranked_top(frame, 1200, order).collect()
    rows = {m: sorted(((r["symbol"], r["score"]) for r in frame.collect() if r["month"] == m), key=lambda x: (-x[1], x[0])) for m in (0, 1)}
    assert {(r["month"], r["rank"], r["symbol"]) for r in got} == {
        (m, k, s) for m, ranked in rows.items() for k, (s, _) in enumerate(ranked[:1200], start=1)
    }


def test_forecast_weights(spark):
    rows = [(1, "A", 0.02), (1, "B", 0.01), (1, "C", -0.01)]
    got = weights.forecast_weights(spark.createDataFrame(rows, "month int, symbol string, prediction double"), SETTINGS)
    assert {r["symbol"]: r["weight"] for r in got.collect()} == pytest.approx(
        {"A": 0.031 / 0.053, "B": 0.021 / 0.053, "C": 0.001 / 0.053}
    )


def test_inverse_vol_leaves_out_unusable_risk(spark):
    rows = [(1, "A", 0.5, 1.0), (1, "B", 0.25, 1.0), (1, "C", 0.0, None), (1, "D", float("nan"), 1.0), (1, "E", float("inf"), 0.0)]
    frame = spark.createDataFrame(rows, "month int, symbol string, annual_vol double, sharpe double")
    got = {r["symbol"]: r["weight"] for r in weights.inverse_vol_weights(frame).collect()}
    assert got == pytest.approx({"A": 1 / 3, "B": 2 / 3})


def test_fallback_fills_only_empty_months(spark):
    primary = weights_from_rows(spark, [(1, "A", 1.0)])
    plain = weights_from_rows(spark, [(1, "B", 1.0), (2, "B", 1.0)])
    got = {(r["month"], r["symbol"]) for r in weights.with_fallback(primary, plain).collect()}
    assert got == {(1, "A"), (2, "B")}


def test_empty_basket_has_the_same_type(spark):
    assert weights_from_rows(spark, []).schema == weights_from_rows(spark, [(1, "A", 1.0)]).schema


def run(make_panel, spark, rows, prices, **options):
    basket = weights_from_rows(spark, rows).withColumn("strategy", F.lit("x"))
    results = holding.holding_returns(basket, make_panel(prices), SCHEDULE, ["x"], **options)
    return {r["month"]: (r["month_return"], r["num_assets"]) for r in results.collect()}


def test_missing_start_is_not_invested(spark, make_panel):
    prices = [("A", JAN, 10.0), ("A", FEB - BAR, 11.0), ("B", JAN + BAR, 5.0), ("B", FEB - BAR, 50.0)]
    got = run(make_panel, spark, [(1, "A", 0.4), (1, "B", 0.6)], prices)
    assert got == {1: (pytest.approx(0.1), 1), 2: (0.0, 0)}


def test_missing_end_earns_nothing(spark, make_panel):
    prices = [("A", JAN, 10.0), ("A", FEB - BAR, 12.0), ("C", JAN, 10.0), ("C", FEB - 2 * BAR, 99.0)]
    got = run(make_panel, spark, [(1, "A", 0.5), (1, "C", 0.5)], prices)
    assert got[1] == (pytest.approx(0.1), 2)


def test_start_bar_of_next_month_is_not_an_end_bar(spark, make_panel):
    prices = [("A", JAN, 10.0), ("A", FEB, 20.0), ("A", MAR - BAR, 30.0)]
    got = run(make_panel, spark, [(1, "A", 1.0), (2, "A", 1.0)], prices)
    assert got == {1: (0.0, 1), 2: (pytest.approx(0.5), 1)}


def test_price_check_drops_after_renormalising(spark, make_panel):
    prices = [("A", JAN, 10.0), ("A", FEB - BAR, 12.0), ("B", JAN, float("inf")), ("B", FEB - BAR, 1.0)]
    got = run(make_panel, spark, [(1, "A", 0.5), (1, "B", 0.5)], prices, price_check=True)
    assert got[1] == (pytest.approx(0.1), 1)


def test_windows(spark):
    rows = holding.rebalance_windows(spark, Schedule(date(2024, 12, 1), months=2, lookback_days=90)).orderBy("month").collect()
    assert rows[0]["lb_start"] == datetime(2024, 12, 1) - timedelta(days=90)
    assert rows[1]["hold_start"] == JAN and rows[1]["hold_end"] == FEB and rows[1]["lb_end"] == JAN
    months = holding.month_sequence(spark, "2024-11", "2025-02").collect()
    assert [tuple(r) for r in months] == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]


def test_performance_by_hand(spark):
    rows = [("x", 1, 0.10, 3), ("x", 2, -0.20, 3), ("x", 3, 0.05, 3), ("flat", 1, 0.0, 0), ("flat", 2, 0.0, 0), ("flat", 3, 0.0, 0)]
    results = spark.createDataFrame(rows, "strategy string, month int, month_return double, num_assets int")
    curve = performance.equity_curve(results, SETTINGS)
    values = [r["portfolio_value"] for r in curve.filter("strategy = 'x'").orderBy("month").collect()]
    assert values == pytest.approx([10_000, 11_000, 8_800, 9_240])
    assert performance.equity_curve(results, SETTINGS, with_start=False).count() == 6
    falls = [r["drawdown"] for r in performance.drawdowns(curve).filter("strategy = 'x'").orderBy("month").collect()]
    assert falls == pytest.approx([0, 0, -0.2, -0.16])
    table = {r["strategy"]: r for r in performance.performance(results, SETTINGS).collect()}
    x = table["x"]
    assert x["total_return"] == pytest.approx(-0.076)
    assert x["ann_return"] == pytest.approx(0.924 ** 4 - 1)
    assert x["ann_volatility"] == pytest.approx(np.std([0.1, -0.2, 0.05]) * np.sqrt(12))
    assert x["max_drawdown"] == pytest.approx(-0.2)
    assert x["win_rate"] == pytest.approx(2 / 3)
    assert table["flat"]["sharpe"] == 0.0 and table["flat"]["max_drawdown"] == 0.0
    assert performance.best_strategy(performance.performance(results, SETTINGS)).head()["strategy"] == "flat"


def test_loss_in_the_first_month_counts_from_the_capital(spark):
    results = spark.createDataFrame([("x", 1, -0.5, 1)], "strategy string, month int, month_return double, num_assets int")
    assert performance.performance(results, SETTINGS).head()["max_drawdown"] == pytest.approx(-0.5)
