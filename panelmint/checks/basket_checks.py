"""Correlation, tournament, selection and weights."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from panelmint.checks import sql
from panelmint.checks.registry import BRANDS, EVENTS, brand_year, events, query, rounded, static
from panelmint.operators import correlation as corr
from panelmint.operators import selection, weights
from panelmint.operators.features import forecast_frame, windowed_forecast_frame
from panelmint.operators.models import mean_prediction, regression_metrics as score_metrics
from panelmint.operators.splits import chronological_split
from panelmint.plans.static_models import StaticModels

STATIC = (sql.EVENT_BARS, sql.RETURNS, sql.EVENT_METRICS, sql.universe(), sql.EDGES)
STATIC_WALK = (*STATIC, sql.STATIC_RANKED, sql.walk(EVENTS.theta, "edges0"))
WINDOW = (sql.BRAND_BARS, sql.WINDOWS, sql.LOOKBACK, sql.WINDOW_RETURNS, sql.WINDOW_METRICS)
WINDOW_WALK = (*WINDOW, sql.CANDIDATES, sql.WINDOW_EDGES, sql.walk(BRANDS.theta, "wedges"))


@query(
    "correlation_edges",
    sql.build(
        *STATIC,
        select="""SELECT i, j, a.symbol AS symbol_i, b.symbol AS symbol_j, round(rho, 6) AS rho
                  FROM edges JOIN universe a ON a.rank - 1 = i JOIN universe b ON b.rank - 1 = j""",
    ),
)
def correlation_edges(spark, folder):
    return rounded(static(spark, folder).named_edges().drop("month"), "rho")


@query(
    "correlation_summary",
    sql.build(
        *STATIC,
        select="""SELECT count(*) AS pairs, count(rho) AS defined_pairs, round(min(rho), 6) AS min_rho,
                         round(max(rho), 6) AS max_rho, round(avg(abs(rho)), 6) AS mean_abs_rho FROM edges""",
    ),
)
def correlation_summary(spark, folder):
    # Small blocks, so that the matrix has several of them at any scale.
    model = StaticModels(events(spark, folder), replace(EVENTS, gram_block=64))
    summary = corr.matrix_summary(model.edges())
    return rounded(summary, "min_rho", "max_rho", "mean_abs_rho")


@query(
    "windowed_correlations",
    sql.build(
        *WINDOW, sql.CANDIDATES, sql.WINDOW_EDGES,
        select="""SELECT month, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(rho, 6) AS rho FROM wedges""",
    ),
)
def windowed_correlations(spark, folder):
    return rounded(brand_year(spark, folder).edges(), "rho")


@query(
    "correlation_tournament",
    sql.build(
        *STATIC_WALK,
        select="SELECT symbol, CAST(ord AS INTEGER) AS ord, round(sharpe, 6) AS sharpe FROM survivors",
        recursive=True,
    ),
)
def correlation_tournament(spark, folder):
    survivors = static(spark, folder).survivors()
    return rounded(survivors.select("symbol", "ord", "sharpe"), "sharpe")


@query(
    "windowed_tournament",
    sql.build(
        *WINDOW_WALK,
        select="SELECT month, symbol, CAST(ord AS INTEGER) AS ord, round(sharpe, 6) AS sharpe FROM survivors",
        recursive=True,
    ),
)
def windowed_tournament(spark, folder):
    survivors = brand_year(spark, folder).survivors()
    return rounded(survivors.select("month", "symbol", "ord", "sharpe"), "sharpe")


BASKET_COLUMNS = ["weight", "sharpe", "annual_ret", "annual_vol"]
BASKET_SQL = f"""SELECT symbol, round((1 / annual_vol) / sum(1 / annual_vol) OVER (), 6) AS weight,
                        round(sharpe, 6) AS sharpe, round(annual_ret, 6) AS annual_ret, round(annual_vol, 6) AS annual_vol
                 FROM (SELECT * FROM {{source}} WHERE sharpe IS NOT NULL ORDER BY sharpe DESC, symbol LIMIT {EVENTS.top_n})"""


@query("smart_basket", sql.build(*STATIC_WALK, select=BASKET_SQL.format(source="survivors"), recursive=True))
def smart_basket(spark, folder):
    return rounded(static(spark, folder).smart_basket(), *BASKET_COLUMNS)


@query(
    "smart_basket_simple",
    sql.build(sql.EVENT_BARS, sql.RETURNS, sql.EVENT_METRICS, select=BASKET_SQL.format(source="metrics")),
)
def smart_basket_simple(spark, folder):
    return rounded(static(spark, folder).simple_basket(), *BASKET_COLUMNS)


@query(
    "basket_report",
    sql.build(
        *STATIC_WALK,
        select=f"""SELECT symbol, round(100 * (1 / annual_vol) / sum(1 / annual_vol) OVER (), 2) AS weight_pct
                   FROM (SELECT * FROM survivors WHERE sharpe IS NOT NULL ORDER BY sharpe DESC, symbol LIMIT {EVENTS.top_n})""",
        recursive=True,
    ),
)
def basket_report(spark, folder):
    return weights.weight_percent(static(spark, folder).smart_basket()).select("symbol", "weight_pct")


@query(
    "inverse_vol_weights",
    sql.build(
        *WINDOW, sql.top_weights("wmetrics", BRANDS.top_n, "basket"),
        select="SELECT month, symbol, round(weight, 6) AS weight FROM basket",
    ),
)
def inverse_vol_weights(spark, folder):
    top = selection.top_sharpe(brand_year(spark, folder).metrics(), BRANDS.top_n)
    return rounded(weights.inverse_vol_weights(top).select("month", "symbol", "weight"), "weight")


# Months without any symbol of this Sharpe ratio have no primary basket.
DEMANDING = 6.0


@query(
    "fallback_basket",
    sql.build(
        *WINDOW,
        f"demanding AS (SELECT * FROM wmetrics WHERE sharpe > {DEMANDING})",
        sql.top_weights("demanding", BRANDS.top_n, "primary_basket"),
        sql.top_weights("wmetrics", BRANDS.top_n, "plain_basket"),
        select="""SELECT month, symbol, round(weight, 6) AS weight FROM primary_basket
                  UNION ALL SELECT month, symbol, round(weight, 6) FROM plain_basket
                  WHERE month NOT IN (SELECT month FROM primary_basket)""",
    ),
)
def fallback_basket(spark, folder):
    table = brand_year(spark, folder).metrics()
    primary = weights.inverse_vol_weights(selection.top_sharpe(table.filter(F.col("sharpe") > DEMANDING), BRANDS.top_n))
    return rounded(weights.with_fallback(primary, weights.fallback_weights(table, BRANDS)), "weight")


GROUPED = "SELECT *, CAST(symbol AS BIGINT) % 5 AS grp FROM metrics WHERE sharpe IS NOT NULL"


def _grouped(spark, folder):
    table = static(spark, folder).metrics
    return table.withColumn("cluster", F.col("symbol").cast("bigint") % 5)


@query(
    "round_robin_selection",
    sql.build(
        sql.EVENT_BARS, sql.RETURNS, sql.EVENT_METRICS,
        f"turns AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY sharpe DESC, symbol) AS turn FROM ({GROUPED}))",
        select=f"""SELECT symbol, grp AS cluster, CAST(turn AS INTEGER) AS group_rank,
                          CAST(row_number() OVER (ORDER BY turn, grp) AS INTEGER) AS rank
                   FROM turns ORDER BY rank LIMIT {EVENTS.top_n}""",
    ),
)
def round_robin_selection(spark, folder):
    chosen = selection.round_robin(_grouped(spark, folder), EVENTS.top_n)
    return chosen.select("symbol", "cluster", "group_rank", "rank")


@query(
    "group_leaders",
    sql.build(
        sql.EVENT_BARS, sql.RETURNS, sql.EVENT_METRICS,
        select=f"""SELECT arg_max(symbol, sharpe) AS symbol, grp AS cluster, round(max(sharpe), 6) AS sharpe
                   FROM ({GROUPED}) GROUP BY grp""",
    ),
)
def group_leaders(spark, folder):
    leaders = selection.group_leaders(_grouped(spark, folder), ("month", "cluster"))
    return rounded(leaders.select("symbol", "cluster", "sharpe"), "sharpe")


# A stand-in forecast that SQL can express: the return of the bar before.
@query(
    "forecast_weights",
    sql.build(
        sql.BRAND_BARS, sql.WINDOWS, sql.LOOKBACK, sql.features("month, symbol", "lookback", "feats"),
        "cuts AS (SELECT month, quantile_disc(timestamp, 0.8) AS split_ts FROM feats_full GROUP BY 1)",
        """preds AS (SELECT f.month, symbol, avg(ret_lag1) AS prediction FROM feats_full f JOIN cuts c
                     ON c.month = f.month WHERE timestamp > split_ts GROUP BY 1, 2)""",
        f"""tops AS (SELECT * FROM preds
                     QUALIFY row_number() OVER (PARTITION BY month ORDER BY prediction DESC, symbol) <= {BRANDS.top_n})""",
        """shifted AS (SELECT *, prediction - min(prediction) OVER (PARTITION BY month) + 0.001 AS s FROM tops)""",
        select="""SELECT month, symbol, round(prediction, 6) AS prediction,
                         round(s / sum(s) OVER (PARTITION BY month), 6) AS weight FROM shifted""",
    ),
)
def forecast_weights(spark, folder):
    run = brand_year(spark, folder)
    split = chronological_split(windowed_forecast_frame(run.panel, run.schedule), BRANDS.train_share)
    scored = split.filter(~F.col("is_train")).withColumn("prediction", F.col("ret_lag1"))
    return rounded(weights.forecast_weights(mean_prediction(scored), BRANDS), "prediction", "weight")


@query(
    "regression_metrics",
    sql.build(
        sql.EVENT_BARS, sql.features("symbol", "bars", "feats"),
        select="""SELECT count(*) AS n, round(sqrt(avg((target - ret_lag1) ** 2)), 6) AS rmse,
                         round(1 - avg((target - ret_lag1) ** 2) / var_pop(target), 6) AS r2 FROM feats_full""",
    ),
)
def regression_metrics(spark, folder):
    frame = forecast_frame(events(spark, folder), EVENTS)
    return rounded(score_metrics(frame.withColumn("prediction", F.col("ret_lag1"))), "rmse", "r2")
