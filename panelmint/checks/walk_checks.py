"""Rebalancing, holding returns and performance."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmint.checks import sql
from panelmint.checks.basket_checks import WINDOW, WINDOW_WALK
from panelmint.checks.registry import BENCHMARK, BRANDS, SPAN, YEAR, brand_year, brands, query, rounded
from panelmint.operators import holding, performance
from panelmint.operators.returns import lookback_bars
from panelmint.operators.weights import share_of_total
from panelmint.plans.walk_forward import DECLARATIVE, WalkForward
from panelmint.sources.exports import weights_from_rows

PLAIN = sql.top_weights("wmetrics", BRANDS.top_n, "plain")
PLAIN_WEIGHTS = "weights AS (SELECT 'top_sharpe' AS strategy, month, symbol, weight FROM plain)"
RESULT_SELECT = "SELECT strategy, month, round(month_return, 6) AS month_return, num_assets FROM results"

WALK = (
    *WINDOW_WALK,
    PLAIN,
    sql.top_weights("survivors", BRANDS.top_n, "diverse"),
    f"""weights AS (
  SELECT 'benchmark' AS strategy, month, '{BENCHMARK}' AS symbol, 1.0 AS weight FROM windows
  UNION ALL SELECT 'top_sharpe', month, symbol, weight FROM plain
  UNION ALL SELECT 'tournament', month, symbol, weight FROM diverse
)""",
    sql.held("weights"),
    sql.results(list(DECLARATIVE)),
)

EQUITY = f"""
equity AS (
  SELECT strategy, 0 AS month, CAST({BRANDS.initial_capital} AS DOUBLE) AS value FROM results GROUP BY 1
  UNION ALL
  SELECT strategy, month, CAST({BRANDS.initial_capital} AS DOUBLE) * product(1 + month_return) OVER (
    PARTITION BY strategy ORDER BY month ROWS UNBOUNDED PRECEDING) FROM results
),
falls AS (
  SELECT *, max(value) OVER (PARTITION BY strategy ORDER BY month ROWS UNBOUNDED PRECEDING) AS peak FROM equity
)"""


def performance_sql(annual: str) -> str:
    return f"""
growth AS (
  SELECT strategy, product(1 + month_return) AS g, count(*) AS n, stddev_pop(month_return) * sqrt(12) AS vol,
         avg(CASE WHEN month_return > 0 THEN 1.0 ELSE 0.0 END) AS win_rate FROM results GROUP BY 1
),
table_rows AS (
  SELECT g.*, {annual} AS ann_return, d.max_drawdown FROM growth g
  JOIN (SELECT strategy, min(value / peak - 1) AS max_drawdown FROM falls GROUP BY 1) d USING (strategy)
)"""


COMPOUND = "pow(1 + (pow(g, 1.0 / n) - 1), 12) - 1"
LINEAR = "(pow(g, 1.0 / n) - 1) * 12"
PERFORMANCE_COLUMNS = [
    "total_return", "ann_return", "ann_volatility", "sharpe", "max_drawdown", "win_rate", "final_value",
]
PERFORMANCE_SELECT = f"""SELECT strategy, round(g - 1, 6) AS total_return, round(ann_return, 6) AS ann_return,
  round(vol, 6) AS ann_volatility, round(CASE WHEN vol > 0 THEN ann_return / vol ELSE 0.0 END, 6) AS sharpe,
  round(max_drawdown, 6) AS max_drawdown, round(win_rate, 6) AS win_rate,
  round(CAST({BRANDS.initial_capital} AS DOUBLE) * g, 6) AS final_value FROM table_rows"""


def _walk(spark, folder):
    return brand_year(spark, folder).run(DECLARATIVE)


@query(
    "rebalance_windows",
    sql.build(
        sql.BRAND_BARS, sql.WINDOWS, sql.LOOKBACK,
        select="""SELECT w.*, coalesce(n, 0) AS bars FROM windows w
                  LEFT JOIN (SELECT month, count(*) AS n FROM lookback GROUP BY 1) USING (month)""",
    ),
)
def rebalance_windows(spark, folder):
    counts = lookback_bars(brand_year(spark, folder).panel, YEAR).groupBy("month").agg(F.count("*").alias("bars"))
    return holding.rebalance_windows(spark, YEAR).join(counts, "month", "left").fillna(0, subset=["bars"])


@query(
    "benchmark_basket",
    sql.build(
        sql.BRAND_BARS, sql.WINDOWS,
        f"weights AS (SELECT 'benchmark' AS strategy, month, '{BENCHMARK}' AS symbol, 1.0 AS weight FROM windows)",
        sql.held("weights"), sql.results(["benchmark"]), select=RESULT_SELECT,
    ),
)
def benchmark_basket(spark, folder):
    return rounded(brand_year(spark, folder).run(("benchmark",)), "month_return")


@query(
    "holding_positions",
    sql.build(
        *WINDOW, PLAIN, PLAIN_WEIGHTS, sql.held("weights"),
        select="""SELECT month, symbol, round(share, 6) AS share, round(px_start, 6) AS px_start,
                         round(px_end, 6) AS px_end, round((px_end - px_start) / px_start, 6) AS ret FROM shares""",
    ),
)
def holding_positions(spark, folder):
    run = brand_year(spark, folder)
    held = holding.holding_positions(run.baskets(("top_sharpe",)), holding.edge_bars(run.panel, YEAR))
    shares = share_of_total(held, "weight", "share").select("month", "symbol", "share", "px_start", "px_end", "ret")
    return rounded(shares, "share", "px_start", "px_end", "ret")


@query(
    "holding_returns",
    sql.build(*WINDOW, PLAIN, PLAIN_WEIGHTS, sql.held("weights"), sql.results(["top_sharpe"]), select=RESULT_SELECT),
)
def holding_returns(spark, folder):
    return rounded(brand_year(spark, folder).run(("top_sharpe",)), "month_return")


# Option of the price check: a stand-in for a bad quote, prices above 1,500 are made unusable.
BAD_PRICE = 1500.0


@query(
    "holding_returns_checked",
    sql.build(
        *WINDOW, PLAIN, PLAIN_WEIGHTS, sql.held("weights"),
        f"""results AS (
  SELECT 'top_sharpe' AS strategy, w.month,
         coalesce(sum(share * (px_end - px_start) / px_start) FILTER (px_start <= {BAD_PRICE}), 0.0) AS month_return,
         CAST(count(symbol) FILTER (px_start <= {BAD_PRICE}) AS INTEGER) AS num_assets
  FROM windows w LEFT JOIN shares s USING (month) GROUP BY 2
)""",
        select=RESULT_SELECT,
    ),
)
def holding_returns_checked(spark, folder):
    run = brand_year(spark, folder)
    starts = F.dayofmonth("timestamp") == 1
    bad = F.when(starts & (F.col("close") > BAD_PRICE), F.lit(float("inf"))).otherwise(F.col("close"))
    # The baskets come from clean prices; only the prices of the holding period are spoilt.
    spoilt = run.panel.withColumn("close", bad)
    checked = holding.holding_returns(run.baskets(("top_sharpe",)), spoilt, YEAR, ["top_sharpe"], price_check=True)
    return rounded(checked, "month_return")


@query("walk_forward", sql.build(*WALK, select=RESULT_SELECT, recursive=True))
def walk_forward(spark, folder):
    return rounded(_walk(spark, folder), "month_return")


@query(
    "equity_curve",
    sql.build(
        *WALK, EQUITY, select="SELECT strategy, month, round(value, 6) AS portfolio_value FROM equity", recursive=True
    ),
)
def equity_curve(spark, folder):
    return rounded(performance.equity_curve(_walk(spark, folder), BRANDS), "portfolio_value")


@query(
    "drawdown",
    sql.build(
        *WALK, EQUITY,
        select="""SELECT strategy, month, round(value, 6) AS portfolio_value, round(peak, 6) AS peak,
                         round((value - peak) / peak, 6) AS drawdown FROM falls""",
        recursive=True,
    ),
)
def drawdown(spark, folder):
    curve = performance.drawdowns(performance.equity_curve(_walk(spark, folder), BRANDS))
    return rounded(curve, "portfolio_value", "peak", "drawdown")


@query(
    "return_table",
    sql.build(
        *WALK,
        select="SELECT strategy, "
        + ", ".join(f"round(max(month_return * 100) FILTER (month = {m}), 6) AS m{m:02d}" for m in range(1, 13))
        + " FROM results GROUP BY 1",
        recursive=True,
    ),
)
def return_table(spark, folder):
    return rounded(performance.return_table(_walk(spark, folder), 12), *[f"m{m:02d}" for m in range(1, 13)])


@query(
    "performance",
    sql.build(*WALK, EQUITY, performance_sql(COMPOUND), select=PERFORMANCE_SELECT, recursive=True),
)
def performance_table(spark, folder):
    return rounded(performance.performance(_walk(spark, folder), BRANDS), *PERFORMANCE_COLUMNS)


@query(
    "performance_linear",
    sql.build(*WALK, EQUITY, performance_sql(LINEAR), select=PERFORMANCE_SELECT, recursive=True),
)
def performance_linear(spark, folder):
    return rounded(performance.performance(_walk(spark, folder), BRANDS, compound=False), *PERFORMANCE_COLUMNS)


@query(
    "best_strategy",
    sql.build(
        *WALK, EQUITY, performance_sql(COMPOUND),
        select=f"{PERFORMANCE_SELECT} ORDER BY CASE WHEN vol > 0 THEN ann_return / vol ELSE 0.0 END DESC, strategy LIMIT 1",
        recursive=True,
    ),
)
def best_strategy(spark, folder):
    table = performance.performance(_walk(spark, folder), BRANDS)
    return rounded(performance.best_strategy(table), *PERFORMANCE_COLUMNS)


@query(
    "performance_report",
    sql.build(
        *WALK, EQUITY, performance_sql(COMPOUND),
        select="""SELECT strategy, format('${:,.0f}', 10000.0::DOUBLE * g) AS final_value,
                         printf('%+.2f%%', (g - 1) * 100) AS total_return, printf('%+.2f%%', ann_return * 100) AS ann_return,
                         printf('%.2f%%', vol * 100) AS ann_volatility,
                         printf('%.2f', CASE WHEN vol > 0 THEN ann_return / vol ELSE 0.0 END) AS sharpe,
                         printf('%.2f%%', max_drawdown * 100) AS max_drawdown, printf('%.1f%%', win_rate * 100) AS win_rate
                  FROM table_rows""",
        recursive=True,
    ),
)
def performance_report(spark, folder):
    return performance.report_lines(performance.performance(_walk(spark, folder), BRANDS))


@query(
    "monthly_report",
    sql.build(
        *WALK,
        select="""SELECT strategy, month, strftime(hold_start, '%b %Y') AS label, round(month_return, 6) AS month_return,
                         num_assets FROM results JOIN windows USING (month)""",
        recursive=True,
    ),
)
def monthly_report(spark, folder):
    return rounded(performance.labelled_results(_walk(spark, folder), YEAR), "month_return")


@query(
    "walk_forward_span",
    sql.build(*[sql.windows(SPAN) if block == sql.WINDOWS else block for block in WALK], select=RESULT_SELECT, recursive=True),
)
def walk_forward_span(spark, folder):
    """The walk-forward over every month of the data."""
    return rounded(WalkForward(brands(spark, folder), SPAN, BRANDS, BENCHMARK).run(DECLARATIVE), "month_return")


# A basket given by hand beside one without rows.
GIVEN = [(m, f"Brand#{b}", w) for m in range(1, 13) for b, w in ((1, 0.5), (2, 0.25), (99, 0.25))]


@query(
    "given_baskets",
    sql.build(
        sql.BRAND_BARS,
        sql.WINDOWS,
        "weights AS (SELECT 'given' AS strategy, * FROM (VALUES " + ", ".join(map(str, GIVEN)) + ") AS g(month, symbol, weight))",
        sql.held("weights"),
        sql.results(["given", "empty"]),
        select=RESULT_SELECT,
    ),
)
def given_baskets(spark, folder):
    run = brand_year(spark, folder)
    given = weights_from_rows(spark, GIVEN).withColumn("strategy", F.lit("given"))
    none = weights_from_rows(spark, []).withColumn("strategy", F.lit("empty"))
    held = holding.holding_returns(given.unionByName(none), run.prices, YEAR, ["given", "empty"], basket_rows=len(GIVEN))
    return rounded(held, "month_return")
