from dataclasses import replace
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmint.config import Schedule, Settings
from panelmint.operators import models, splits
from panelmint.operators.features import FEATURES, forecast_frame
from panelmint.plans.static_models import StaticModels
from panelmint.plans.walk_forward import DECLARATIVE, FITTED, WalkForward

from tests.conftest import BAR, START

SETTINGS = Settings(
    min_obs=20, theta=0.3, top_n=4, clusters=3, static_trees=3, monthly_trees=2, monthly_depth=2, chunk_bars=64
)
SCHEDULE = Schedule(date(2025, 2, 1), months=2, lookback_days=30)


@pytest.fixture(scope="module")
def walk(make_panel):
    """Ten symbols with a common move over ten weeks; some drop out, one appears late."""
    rng = np.random.default_rng(11)
    common = rng.normal(0, 0.01, 420)
    rows = []
    for k in range(10):
        own = rng.normal(0.0005 * k, 0.004 * (k + 1), 420)
        price = 100 * np.exp(np.cumsum(common * (k % 3) + own))
        first, last = (200, 420) if k == 9 else (0, 420 - 25 * (k % 2))
        rows += [(f"S{k}", START + b * BAR, float(price[b])) for b in range(first, last)]
    panel = make_panel(rows).persist()
    return WalkForward(panel, SCHEDULE, SETTINGS, "S0")


def test_clusters(spark, walk):
    static = StaticModels(walk.panel, SETTINGS)
    clustered = static.clusters()
    first = {r["symbol"]: r["cluster"] for r in clustered.collect()}
    again = {r["symbol"]: r["cluster"] for r in StaticModels(walk.panel, SETTINGS).clusters().collect()}
    assert first == again and set(first.values()) <= {0, 1, 2} and len(first) == 10
    assert -1 <= models.silhouette(clustered) <= 1
    profile = models.cluster_profile(clustered).collect()
    assert sum(r["size"] for r in profile) == 10 and all(r["sd_sharpe"] >= 0 for r in profile)
    assert models.nearest_centres(clustered).filter("own_distance > least_distance + 0.05").count() == 0


def test_few_symbols_get_fewer_clusters(spark):
    rows = [(1, "A", 0.1, 0.2, 0.5), (2, "A", 0.1, 0.2, 0.5), (2, "B", 0.3, 0.2, 1.5)]
    metrics = spark.createDataFrame(rows, "month int, symbol string, annual_ret double, annual_vol double, sharpe double")
    got = models.cluster_assets(metrics, SETTINGS).collect()
    assert len(got) == 3 and {r["cluster"] for r in got if r["month"] == 2} == {0, 1}
    assert models.cluster_assets(metrics.limit(0), SETTINGS).count() == 0


def test_static_forecast(walk):
    model, scored = StaticModels(walk.panel, SETTINGS).forecast()
    table = models.regression_metrics(scored).head()
    assert {"rmse": table["rmse"], "r2": table["r2"]} == pytest.approx(models.evaluate_forecast(scored))
    importance = models.feature_importance(model, scored).collect()
    assert sum(r["pct_of_total"] for r in importance) == pytest.approx(1)
    assert {r["feature"] for r in importance} == set(FEATURES)


@pytest.mark.parametrize("strategy", DECLARATIVE + FITTED)
def test_weights_sum_to_one_per_month(walk, strategy):
    basket = getattr(walk, strategy)()
    sums = {r["month"]: (r["s"], r["n"]) for r in basket.groupBy("month").agg(F.sum("weight").alias("s"), F.count("*").alias("n")).collect()}
    assert set(sums) == {1, 2}
    assert all(s == pytest.approx(1) and n <= SETTINGS.top_n for s, n in sums.values())


@pytest.mark.parametrize("strategy", DECLARATIVE + FITTED)
def test_no_lookahead(walk, strategy):
    """Prices at or after the start of the holding month do not change that month's basket."""
    hold = SCHEDULE.hold_starts[0]
    noise = F.when(F.col("timestamp") >= F.lit(hold), F.col("close") * (2 + F.hash("symbol", "timestamp") % 2)).otherwise(F.col("close"))
    other = replace(walk, panel=walk.panel.withColumn("close", noise))

    def january(run):
        return sorted((r["symbol"], round(r["weight"], 9)) for r in getattr(run, strategy)().filter("month = 1").collect())

    assert january(walk) == january(other)


def test_months_fitted_together_forecast_the_same_rows(walk):
    """Fitted together or one by one: the same months and symbols, and forecasts that go together."""
    alone, joint = (
        {(r["month"], r["symbol"]): r["prediction"] for r in replace(walk, settings=replace(SETTINGS, months_one_by_one=n)).predictions().collect()}
        for n in (2, 1)
    )
    assert alone.keys() == joint.keys()
    assert np.corrcoef([alone[k] for k in alone], [joint[k] for k in alone])[0, 1] > 0.9


def test_results_cover_every_strategy_and_month(walk):
    quiet = replace(walk, schedule=Schedule(date(2025, 2, 1), months=4, lookback_days=30))
    names = ("benchmark", "top_sharpe", "forecast")
    got = {(r["strategy"], r["month"]): (r["month_return"], r["num_assets"]) for r in quiet.run(names).collect()}
    assert len(got) == 12
    # The data ends in March: April and May have nothing to trade.
    assert all(got[s, m] == (0.0, 0) for s in names for m in (3, 4))
    assert got["benchmark", 1][1] == 1


def test_tournament_leaves_no_strong_pair(walk):
    alive = {(r["month"], r["ord"]) for r in walk.survivors().collect()}
    strong = walk.edges().filter(F.abs("rho") > SETTINGS.theta).collect()
    assert strong and not [r for r in strong if (r["month"], r["i"]) in alive and (r["month"], r["j"]) in alive]


def test_row_cap_is_exact_and_nested(walk):
    frame = forecast_frame(walk.panel, SETTINGS).persist()
    total = frame.count()
    picks = {n: {tuple(r) for r in splits.row_cap(frame, n).select("symbol", "timestamp").collect()} for n in (0, 1, 77, total, total + 5)}
    assert [len(picks[n]) for n in picks] == [0, 1, 77, total, total]
    assert picks[1] <= picks[77]


def test_row_cap_bounds_training_rows_only(walk):
    """The cap bites, and every held-out row is still scored."""
    frame = forecast_frame(walk.panel, SETTINGS)
    split = splits.hash_split(frame, SETTINGS.train_share).persist()
    held, total = split.filter("not is_train").count(), split.count()
    capped = splits.row_cap(split, total // 10)
    assert 0 < capped.filter("not is_train").count() < capped.count() == total // 10
    _, scored = StaticModels(walk.panel, replace(SETTINGS, row_cap=total // 10)).forecast()
    assert scored.count() == held


def test_hash_split_does_not_depend_on_partitions(walk):
    frame = forecast_frame(walk.panel, SETTINGS)
    one, many = (
        {tuple(r) for r in splits.hash_split(f, 0.8).select("symbol", "timestamp", "is_train").collect()}
        for f in (frame.coalesce(1), frame.repartition(13))
    )
    assert one == many
    assert 0.75 < sum(t for *_, t in one) / len(one) < 0.85


def test_chronological_split_takes_the_exact_quantile(spark):
    rows = [(1, "A", datetime(2025, 1, 1) + timedelta(days=d)) for d in (1, 2, 3, 4, 5, 5, 5, 5, 9, 10)] + [(2, "A", datetime(2025, 1, 1))]
    got = splits.chronological_split(spark.createDataFrame(rows, "month int, symbol string, timestamp timestamp_ntz"), 0.8)
    cut = {r["month"]: r["split_ts"].day for r in got.collect()}
    assert cut == {1: 6, 2: 1}
    assert got.filter("month = 1 and is_train").count() == 8


@pytest.mark.parametrize("error", [0.01, 0.001])
def test_approximate_split_keeps_its_error(spark, error):
    """Sorted, skewed and tied times, and a single row; ranks against the exact ones."""
    rng = np.random.default_rng(6)
    at = lambda s: datetime(2025, 1, 1) + timedelta(seconds=int(s))
    months = {1: np.arange(20_000), 2: (rng.pareto(0.7, 20_000) * 100).clip(0, 1e8), 3: rng.integers(0, 4, 20_000), 4: np.array([7])}
    rows = [(m, "A", at(s)) for m, seconds in months.items() for s in seconds]
    frame = spark.createDataFrame(rows, "month int, symbol string, timestamp timestamp_ntz").repartition(6)
    cuts = {r["month"]: r["split_ts"] for r in splits.approximate_cut(frame, 0.8, error).collect()}
    for m, seconds in months.items():
        times = np.sort([at(s) for s in seconds])
        low, high = np.searchsorted(times, cuts[m], "left"), np.searchsorted(times, cuts[m], "right")
        assert low < high and low <= (0.8 + error) * len(times) and high >= (0.8 - error) * len(times)
    split = splits.chronological_split(frame, 0.8, error)
    assert split.where("is_train <> (timestamp <= split_ts)").count() == 0 and split.count() == len(rows)
    with pytest.raises(ValueError):
        splits.approximate_cut(frame, 0.8, 0.0)
