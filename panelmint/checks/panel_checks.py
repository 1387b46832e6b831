"""Panels, returns, metrics, features and splits."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from panelmint.checks import sql
from panelmint.checks.registry import BRANDS, EVENTS, YEAR, brand_year, brands, events, query, rounded, static
from panelmint.functions.expressions import epoch_micros, epoch_to_timestamp, month_index, valid_risk
from panelmint.operators import features, holding, metrics, returns, selection, splits
from panelmint.sources import tables
from panelmint.sources.klines import times_by_column
from panelmint.sources.lake import partition_columns

FEATURE_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in features.FEATURES)


@query("bars", sql.build(sql.EVENT_BARS, select="SELECT timestamp, symbol, round(close, 6) AS close FROM bars"))
def bars(spark, folder):
    return rounded(events(spark, folder), "close")


@query(
    "epoch_normalise",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN ts WHEN 1 THEN CAST(date_trunc('milliseconds', ts) AS TIMESTAMP)
              ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END AS timestamp FROM events""",
)
def epoch_normalise(spark, folder):
    micros = epoch_micros(F.col("ts"))
    unit = F.col("event_id") % 3
    epoch = (
        F.when(unit == 0, micros)
        .when(unit == 1, F.floor(micros / 1_000))
        .otherwise(F.floor(micros / 1_000_000))
    )
    return tables.table(spark, folder, "events").select("event_id", epoch_to_timestamp(epoch).alias("timestamp"))


@query(
    "epoch_by_column",
    """WITH texts AS (
  SELECT event_id, event_type, CASE
    WHEN event_id % 50 = 7 THEN 'n/a'
    WHEN event_type = 'view' THEN CAST(epoch_us(ts) AS VARCHAR)
    WHEN event_type = 'click' THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
    WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) END AS text
  FROM events),
nums AS (SELECT *, try_cast(text AS DOUBLE) AS v FROM texts),
units AS (
  SELECT event_type, CASE WHEN NOT count(v) > 0.95 * count(*) THEN 'text' WHEN median(v) >= 1e15 THEN 'us'
                          WHEN median(v) >= 1e12 THEN 'ms' ELSE 's' END AS unit
  FROM nums GROUP BY 1),
times AS (
  SELECT event_id, event_type, unit, CASE unit
    WHEN 'us' THEN make_timestamp(CAST(v AS BIGINT)) WHEN 'ms' THEN make_timestamp(CAST(v * 1000 AS BIGINT))
    WHEN 's' THEN make_timestamp(CAST(v * 1000000 AS BIGINT)) ELSE try_cast(text AS TIMESTAMP) END AS timestamp
  FROM nums JOIN units USING (event_type))
SELECT * FROM times WHERE timestamp IS NOT NULL""",
)
def epoch_by_column(spark, folder):
    micros = epoch_micros(F.col("ts"))
    kind = F.col("event_type")
    text = (
        F.when(F.col("event_id") % 50 == 7, "n/a")
        .when(kind == "view", micros.cast("string"))
        .when(kind == "click", F.floor(micros / 1_000).cast("string"))
        .when(kind == "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.floor(micros / 1_000_000).cast("string"))
    )
    rows = tables.table(spark, folder, "events").select("event_id", "event_type", text.alias("text"))
    parsed = times_by_column(rows, "event_type", "text")
    return parsed.filter(F.col("timestamp").isNotNull()).select("event_id", "event_type", "unit", "timestamp")


@query(
    "month_id",
    sql.build(
        sql.BRAND_BARS,
        select="""SELECT CAST((year(timestamp) - 1997) * 12 + month(timestamp) AS INTEGER) AS month_id, count(*) AS rows
                  FROM bars GROUP BY 1 ORDER BY 1""",
    ),
)
def month_id(spark, folder):
    index = month_index(F.year("timestamp"), F.month("timestamp"), 1997)
    return brands(spark, folder).groupBy(index.alias("month_id")).agg(F.count("*").alias("rows")).orderBy("month_id")


@query(
    "partition_columns",
    sql.build(
        sql.EVENT_BARS,
        select="""SELECT timestamp, symbol, CAST(year(timestamp) AS INTEGER) AS year,
                         CAST(month(timestamp) AS INTEGER) AS month FROM bars""",
    ),
)
def partitions(spark, folder):
    return partition_columns(events(spark, folder)).select("timestamp", "symbol", "year", "month")


@query(
    "lake_verification",
    sql.build(
        sql.BRAND_BARS,
        select="""SELECT CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month,
                         count(*) AS rows, count(DISTINCT symbol) AS symbols FROM bars GROUP BY 1, 2
                  UNION ALL SELECT 0, 0, count(*), count(DISTINCT symbol) FROM bars""",
    ),
)
def lake_verification(spark, folder):
    return metrics.panel_totals(brands(spark, folder))


@query(
    "time_window_filter",
    sql.build(
        sql.BRAND_BARS,
        select="""SELECT timestamp, symbol, round(close, 6) AS close FROM bars
                  WHERE timestamp >= TIMESTAMP '1997-01-01' AND timestamp < TIMESTAMP '1997-04-01'""",
    ),
)
def time_window_filter(spark, folder):
    quarter = returns.time_range(brands(spark, folder), datetime(1997, 1, 1), datetime(1997, 4, 1))
    return rounded(quarter, "close")


@query(
    "symbol_semi_join",
    sql.build(
        sql.EVENT_BARS,
        select="""SELECT timestamp, symbol, round(close, 6) AS close FROM bars WHERE symbol IN
                  (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'MACHINERY')""",
    ),
)
def symbol_semi_join(spark, folder):
    customers = tables.table(spark, folder, "customer").filter(F.col("c_mktsegment") == "MACHINERY")
    known = customers.select(F.col("c_custkey").cast("string").alias("symbol"))
    return rounded(returns.only_symbols(events(spark, folder), known), "close")


@query(
    "exact_bar_lookup",
    sql.build(
        sql.BRAND_BARS,
        sql.WINDOWS,
        select="""SELECT timestamp, symbol, round(close, 6) AS close FROM bars
                  WHERE timestamp IN (SELECT hold_start FROM windows)""",
    ),
)
def exact_bar_lookup(spark, folder):
    return rounded(returns.bars_at(brands(spark, folder), YEAR.hold_starts), "close")


@query(
    "log_returns",
    sql.build(sql.EVENT_BARS, sql.RETURNS, select="SELECT symbol, timestamp, round(ret, 6) AS ret FROM rets"),
)
def log_returns(spark, folder):
    return rounded(returns.log_returns(events(spark, folder), EVENTS), "ret")


@query(
    "windowed_returns",
    sql.build(
        sql.BRAND_BARS, sql.WINDOWS, sql.LOOKBACK, sql.WINDOW_RETURNS,
        select="SELECT month, symbol, timestamp, round(ret, 6) AS ret FROM wrets",
    ),
)
def windowed_returns(spark, folder):
    return rounded(returns.windowed_returns(brands(spark, folder), YEAR, BRANDS), "ret")


METRIC_COLUMNS = ["sum_log_ret", "std_log_ret", "annual_ret", "annual_vol", "sharpe"]
METRIC_SQL = "count, " + ", ".join(f"round({c}, 6) AS {c}" for c in METRIC_COLUMNS)


@query(
    "asset_metrics",
    sql.build(sql.EVENT_BARS, sql.RETURNS, sql.EVENT_METRICS, select=f"SELECT symbol, {METRIC_SQL} FROM metrics"),
)
def asset_metrics(spark, folder):
    table = metrics.asset_metrics(returns.log_returns(events(spark, folder), EVENTS), EVENTS)
    return rounded(table, *METRIC_COLUMNS)


@query(
    "windowed_metrics",
    sql.build(
        sql.BRAND_BARS, sql.WINDOWS, sql.LOOKBACK, sql.WINDOW_RETURNS, sql.WINDOW_METRICS,
        select=f"SELECT month, symbol, {METRIC_SQL} FROM wmetrics WHERE annual_vol > 0 AND sharpe IS NOT NULL",
    ),
)
def windowed_metrics(spark, folder):
    table = brand_year(spark, folder).metrics().filter(valid_risk(F.col("annual_vol"), F.col("sharpe")))
    return rounded(table.drop("first_bar"), *METRIC_COLUMNS)


@query(
    "universe_cap",
    sql.build(sql.EVENT_BARS, sql.universe(100), select="SELECT symbol, n_obs, CAST(rank AS INTEGER) AS rank FROM universe"),
)
def universe_cap(spark, folder):
    capped = selection.universe_cap(events(spark, folder), replace(EVENTS, max_symbols=100))
    return capped.select("symbol", "n_obs", "rank")


@query(
    "observation_counts",
    sql.build(sql.EVENT_BARS, select="SELECT symbol, count(*) AS n_obs FROM bars GROUP BY 1"),
)
def observation_counts(spark, folder):
    return metrics.observation_counts(events(spark, folder))


@query(
    "candidate_cap",
    sql.build(
        sql.BRAND_BARS, sql.WINDOWS, sql.LOOKBACK, sql.WINDOW_RETURNS, sql.WINDOW_METRICS,
        select="""SELECT month, symbol, round(sharpe, 6) AS sharpe,
                         CAST(row_number() OVER (PARTITION BY month ORDER BY sharpe DESC, symbol) AS INTEGER) AS rank
                  FROM wmetrics WHERE annual_vol > 0 AND sharpe IS NOT NULL
                  QUALIFY row_number() OVER (PARTITION BY month ORDER BY sharpe DESC, symbol) <= 10""",
    ),
)
def candidate_cap(spark, folder):
    capped = selection.candidate_cap(brand_year(spark, folder).metrics(), replace(BRANDS, max_symbols=10))
    return rounded(capped.select("month", "symbol", "sharpe", "rank"), "sharpe")


@query(
    "top_sharpe",
    sql.build(
        sql.EVENT_BARS, sql.RETURNS, sql.EVENT_METRICS,
        select="""SELECT symbol, round(sharpe, 6) AS sharpe FROM metrics WHERE sharpe IS NOT NULL
                  ORDER BY metrics.sharpe DESC, symbol LIMIT 5""",
    ),
)
def top_sharpe(spark, folder):
    table = metrics.asset_metrics(returns.log_returns(events(spark, folder), EVENTS), EVENTS)
    return rounded(selection.best_symbols(table, 5).select("symbol", "sharpe"), "sharpe")


@query(
    "rolling_features",
    sql.build(
        sql.EVENT_BARS, sql.features("symbol", "bars", "feats"),
        select=f"""SELECT symbol, timestamp, round(log_ret, 6) AS log_ret, {FEATURE_SQL}, round(ma7, 6) AS ma7,
                          round(ma30, 6) AS ma30, round(target, 6) AS target FROM feats""",
    ),
)
def rolling_features(spark, folder):
    table = features.rolling_features(events(spark, folder), EVENTS).drop("close")
    return rounded(table, "log_ret", *features.FEATURES, "ma7", "ma30", "target")


@query(
    "forecast_frame",
    sql.build(
        sql.EVENT_BARS, sql.features("symbol", "bars", "feats"),
        select=f"SELECT symbol, timestamp, {FEATURE_SQL}, round(target, 6) AS target FROM feats_full",
    ),
)
def forecast_frame(spark, folder):
    return rounded(features.forecast_frame(events(spark, folder), EVENTS), *features.FEATURES, "target")


DIGEST = "md5(concat_ws('|', symbol, CAST(epoch_us(timestamp) AS VARCHAR)))"
CAP_DIGEST = "md5(concat_ws('|', 'cap', symbol, CAST(epoch_us(timestamp) AS VARCHAR)))"


@query(
    "hash_split",
    sql.build(
        sql.EVENT_BARS, sql.features("symbol", "bars", "feats"),
        select=f"SELECT symbol, timestamp, ('0x' || substr({DIGEST}, 1, 8))::BIGINT < 3435973836 AS is_train FROM feats_full",
    ),
)
def hash_split(spark, folder):
    frame = features.forecast_frame(events(spark, folder), EVENTS)
    return splits.hash_split(frame, EVENTS.train_share).select("symbol", "timestamp", "is_train")


@query(
    "row_cap",
    sql.build(
        sql.EVENT_BARS, sql.features("symbol", "bars", "feats"),
        select=f"SELECT symbol, timestamp, round(target, 6) AS target FROM feats_full ORDER BY {CAP_DIGEST} LIMIT 2000",
    ),
)
def row_cap(spark, folder):
    capped = splits.row_cap(features.forecast_frame(events(spark, folder), EVENTS), 2000)
    return rounded(capped.select("symbol", "timestamp", "target"), "target")


@query(
    "chrono_split",
    sql.build(
        sql.BRAND_BARS, sql.WINDOWS, sql.LOOKBACK, sql.features("month, symbol", "lookback", "feats"),
        select="""SELECT f.month, symbol, timestamp, split_ts, timestamp <= split_ts AS is_train FROM feats_full f
                  JOIN (SELECT month, quantile_disc(timestamp, 0.8) AS split_ts FROM feats_full GROUP BY 1) q
                  ON q.month = f.month""",
    ),
)
def chrono_split(spark, folder):
    frame = features.windowed_forecast_frame(brands(spark, folder), YEAR)
    return splits.chronological_split(frame, BRANDS.train_share).select(
        "month", "symbol", "timestamp", "split_ts", "is_train"
    )


@query(
    "chrono_split_approx",
    sql.build(
        sql.BRAND_BARS, sql.WINDOWS, sql.LOOKBACK, sql.features("month, symbol", "lookback", "feats"),
        select="SELECT month, count(*) AS n_rows, true AS within FROM feats_full GROUP BY 1",
    ),
)
def chrono_split_approx(spark, folder):
    """Rows of each month, and whether its approximate cut is a quantile within an error of 0.01."""
    error = 0.01
    frame = features.windowed_forecast_frame(brands(spark, folder), YEAR)
    split = splits.chronological_split(frame, BRANDS.train_share, error)
    below = F.count(F.when(F.col("timestamp") < F.col("split_ts"), 1))
    upto, n = F.count(F.when(F.col("is_train"), 1)), F.count("*")
    within = (below <= (BRANDS.train_share + error) * n) & (upto >= (BRANDS.train_share - error) * n) & (upto > below)
    return split.groupBy("month").agg(n.alias("n_rows"), within.alias("within"))


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "wide_returns",
    sql.build(
        sql.part_bars("p_type"), sql.RETURNS,
        select="SELECT timestamp, "
        + ", ".join(f"round(coalesce(max(ret) FILTER (symbol = '{t}'), 0.0), 6) AS {t}" for t in TYPES)
        + " FROM rets GROUP BY 1",
    ),
)
def wide_returns(spark, folder):
    panel = tables.part_bars(spark, folder, "p_type")
    return rounded(returns.wide_returns(returns.log_returns(panel, BRANDS), TYPES), *TYPES)


@query(
    "sparse_returns",
    sql.build(
        sql.EVENT_BARS, sql.RETURNS,
        "numbers AS (SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS number FROM (SELECT DISTINCT symbol FROM rets WHERE ret IS NOT NULL))",
        select="""SELECT timestamp, number // 64 AS block, string_agg(number % 64, ',' ORDER BY number) AS indices,
                  round(sum(ret), 6) AS total, round(sum(ret * (number % 64 + 1)), 6) AS weighted
                  FROM rets JOIN numbers USING (symbol) WHERE ret IS NOT NULL GROUP BY 1, 2""",
    ),
)
def sparse_returns(spark, folder):
    """Sparse rows of all event symbols in blocks of 64, values as two sums."""
    rets = returns.log_returns(events(spark, folder), EVENTS)
    rows = returns.sparse_returns(rets, returns.symbol_numbers(rets), block=64)
    zero = F.lit(0.0)
    weighted = F.zip_with("indices", "values", lambda k, v: (k + 1) * v)
    return rounded(
        rows.select(
            "timestamp", F.col("block").cast("long").alias("block"), F.array_join("indices", ",").alias("indices"),
            F.aggregate("values", zero, lambda a, v: a + v).alias("total"), F.aggregate(weighted, zero, lambda a, v: a + v).alias("weighted"),
        ),
        "total", "weighted",
    )


@query(
    "zscore",
    sql.build(
        sql.EVENT_BARS, sql.RETURNS, sql.EVENT_METRICS,
        select="SELECT symbol, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}_z"
            for c in ("annual_ret", "annual_vol", "sharpe")
        )
        + " FROM metrics",
    ),
)
def zscore(spark, folder):
    columns = ["annual_ret", "annual_vol", "sharpe"]
    scaled = metrics.zscores(static(spark, folder).metrics, columns).select("symbol", *[f"{c}_z" for c in columns])
    return rounded(scaled, *[f"{c}_z" for c in columns])


@query(
    "month_sequence",
    """SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, count(o_orderkey) AS orders
       FROM (SELECT unnest(generate_series(DATE '1995-11-01', DATE '1997-02-01', INTERVAL 1 MONTH)) AS m)
       LEFT JOIN orders ON date_trunc('month', o_orderdate) = m GROUP BY 1, 2""",
)
def month_sequence(spark, folder):
    orders = (
        tables.table(spark, folder, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
        .agg(F.count("o_orderkey").alias("orders"))
    )
    months = holding.month_sequence(spark, "1995-11", "1997-02")
    return months.join(orders, ["year", "month"], "left").fillna(0, subset=["orders"])
