"""Building blocks of the SQL twins. Each block is a list of common table expressions."""

from __future__ import annotations

from panelmint.checks.registry import BRANDS, EVENTS, YEAR
from panelmint.config import Schedule

EVENT_BARS = """
bars AS (
  SELECT time_bucket(INTERVAL '4 hours', ts) AS timestamp, CAST(user_id AS VARCHAR) AS symbol,
         arg_max(value, ts) AS close
  FROM events GROUP BY 1, 2 HAVING arg_max(value, ts) IS NOT NULL
)"""


def part_bars(label: str) -> str:
    return f"""
bars AS (
  SELECT l_shipdate AS timestamp, {label} AS symbol, sum(l_extendedprice) / sum(l_quantity) AS close
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
  HAVING sum(l_extendedprice) / sum(l_quantity) IS NOT NULL
)"""


BRAND_BARS = part_bars("p_brand")

RETURNS = """
lagged AS (
  SELECT symbol, timestamp, close, lag(close) OVER (PARTITION BY symbol ORDER BY timestamp) AS prev FROM bars
),
rets AS (SELECT symbol, timestamp, ln(close / prev) AS ret FROM lagged WHERE prev > 0 AND close > 0)"""

def windows(schedule: Schedule) -> str:
    return f"""
windows AS (
  SELECT CAST(k AS INTEGER) AS month, s - INTERVAL {schedule.lookback_days} DAY AS lb_start, s AS lb_end,
         s AS hold_start, s + INTERVAL 1 MONTH AS hold_end
  FROM (SELECT k, TIMESTAMP '{schedule.first}' + to_months(CAST(k - 1 AS INTEGER)) AS s FROM range(1, {schedule.months + 1}) AS r(k))
)"""


WINDOWS = windows(YEAR)

LOOKBACK = """
lookback AS (
  SELECT month, symbol, timestamp, close FROM bars JOIN windows ON timestamp >= lb_start AND timestamp < lb_end
)"""

WINDOW_RETURNS = """
wlag AS (
  SELECT *, lag(close) OVER (PARTITION BY month, symbol ORDER BY timestamp) AS prev FROM lookback
),
wrets AS (SELECT month, symbol, timestamp, ln(close / prev) AS ret FROM wlag WHERE prev > 0 AND close > 0)"""


def metrics(source: str, periods: float, min_obs: int, keys: str = "symbol", name: str = "metrics") -> str:
    return f"""
{name} AS (
  SELECT *, CASE WHEN annual_vol > 0 THEN annual_ret / annual_vol END AS sharpe FROM (
    SELECT {keys}, count(ret) AS count, sum(ret) AS sum_log_ret, stddev_samp(ret) AS std_log_ret,
           sum(ret) * ({float(periods)} / count(ret)) AS annual_ret,
           stddev_samp(ret) * sqrt({float(periods)}) AS annual_vol
    FROM {source} GROUP BY ALL HAVING count(ret) > {min_obs})
)"""


EVENT_METRICS = metrics("rets", EVENTS.periods_per_year, EVENTS.min_obs)
WINDOW_METRICS = metrics("wrets", BRANDS.periods_per_year, BRANDS.min_obs, "month, symbol", "wmetrics")


def universe(cap: int | None = None) -> str:
    limit = "" if cap is None else f"QUALIFY row_number() OVER (ORDER BY count(*) DESC, symbol) <= {cap}"
    return f"""
universe AS (
  SELECT symbol, count(*) AS n_obs, row_number() OVER (ORDER BY count(*) DESC, symbol) AS rank
  FROM bars GROUP BY symbol {limit}
)"""


# Dense zero-filled matrix of the universe, and DuckDB's own correlation over it.
EDGES = """
cells AS (SELECT timestamp, rank - 1 AS ord, ret FROM rets JOIN universe USING (symbol)),
stamps AS (SELECT DISTINCT timestamp FROM cells),
members AS (SELECT DISTINCT ord FROM cells),
dense AS (
  SELECT s.timestamp, m.ord, coalesce(c.ret, 0.0) AS ret
  FROM stamps s CROSS JOIN members m LEFT JOIN cells c ON c.timestamp = s.timestamp AND c.ord = m.ord
),
edges AS (
  SELECT CAST(a.ord AS INTEGER) AS i, CAST(b.ord AS INTEGER) AS j, corr(a.ret, b.ret) AS rho
  FROM dense a JOIN dense b ON a.timestamp = b.timestamp AND a.ord < b.ord GROUP BY 1, 2
)"""


def walk(theta: float, edges: str = "edges", ranked: str = "ranked") -> str:
    """Sequential tournament per month over `edges(month, i, j, rho)` and `ranked(month, ord, sharpe)`."""
    return f"""
contests AS (
  SELECT e.month, e.i, e.j, CASE WHEN a.sharpe < b.sharpe THEN e.i ELSE e.j END AS loser,
         row_number() OVER (PARTITION BY e.month ORDER BY e.i, e.j) AS k
  FROM {edges} e JOIN {ranked} a ON a.month = e.month AND a.ord = e.i
  JOIN {ranked} b ON b.month = e.month AND b.ord = e.j
  WHERE abs(e.rho) > {theta} AND a.sharpe IS NOT NULL AND b.sharpe IS NOT NULL
),
walk AS (
  SELECT DISTINCT month, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS dropped FROM {ranked}
  UNION ALL
  SELECT w.month, w.k + 1,
         CASE WHEN list_contains(w.dropped, c.i) OR list_contains(w.dropped, c.j) THEN w.dropped
              ELSE list_append(w.dropped, CAST(c.loser AS BIGINT)) END
  FROM walk w JOIN contests c ON c.month = w.month AND c.k = w.k + 1
),
losers AS (
  SELECT month, unnest(dropped) AS ord FROM walk QUALIFY k = max(k) OVER (PARTITION BY month)
),
survivors AS (
  SELECT r.* FROM {ranked} r LEFT JOIN losers l ON l.month = r.month AND l.ord = r.ord WHERE l.ord IS NULL
)"""


STATIC_RANKED = """
edges0 AS (SELECT 0 AS month, i, j, rho FROM edges),
ranked AS (
  SELECT 0 AS month, u.symbol, u.rank - 1 AS ord, m.annual_ret, m.annual_vol, m.sharpe
  FROM universe u LEFT JOIN metrics m USING (symbol)
)"""

CANDIDATES = """
ranked AS (
  SELECT month, symbol, annual_vol, sharpe, row_number() OVER (PARTITION BY month ORDER BY sharpe DESC, symbol) - 1 AS ord
  FROM wmetrics WHERE annual_vol > 0 AND sharpe IS NOT NULL
)"""

# Candidates' matrix per month; its rows are all timestamps at which any symbol has a return.
WINDOW_EDGES = """
wcells AS (SELECT r.month, r.timestamp, c.ord, r.ret FROM wrets r JOIN ranked c ON c.month = r.month AND c.symbol = r.symbol),
wstamps AS (SELECT DISTINCT month, timestamp FROM wrets),
wdense AS (
  SELECT s.month, s.timestamp, m.ord, coalesce(c.ret, 0.0) AS ret
  FROM wstamps s JOIN ranked m ON m.month = s.month
  LEFT JOIN wcells c ON c.month = s.month AND c.timestamp = s.timestamp AND c.ord = m.ord
),
wedges AS (
  SELECT a.month, a.ord AS i, b.ord AS j, corr(a.ret, b.ret) AS rho
  FROM wdense a JOIN wdense b ON a.month = b.month AND a.timestamp = b.timestamp AND a.ord < b.ord GROUP BY ALL
)"""


def top_weights(source: str, n: int, name: str) -> str:
    """Best Sharpe ratios per month with inverse-volatility weights."""
    return f"""
{name} AS (
  SELECT month, symbol, annual_vol, sharpe, (1 / annual_vol) / sum(1 / annual_vol) OVER (PARTITION BY month) AS weight
  FROM (SELECT * FROM {source} WHERE sharpe IS NOT NULL AND annual_vol > 0
        QUALIFY row_number() OVER (PARTITION BY month ORDER BY sharpe DESC, symbol) <= {n})
)"""


def held(weights: str) -> str:
    """Strict point-in-time returns of `weights(strategy, month, symbol, weight)`."""
    return f"""
tradable AS (
  SELECT w.strategy, w.month, w.symbol, w.weight, s.close AS px_start, coalesce(e.close, s.close) AS px_end
  FROM {weights} w JOIN windows USING (month)
  JOIN bars s ON s.symbol = w.symbol AND s.timestamp = hold_start
  LEFT JOIN bars e ON e.symbol = w.symbol AND e.timestamp = hold_end - INTERVAL 1 DAY
),
shares AS (
  SELECT *, weight / sum(weight) OVER (PARTITION BY strategy, month) AS share FROM tradable
)"""


def results(strategies: list[str]) -> str:
    names = ", ".join(f"('{s}')" for s in strategies)
    return f"""
earned AS (
  SELECT strategy, month, sum(share * (px_end - px_start) / px_start) AS month_return, count(symbol) AS n
  FROM shares GROUP BY 1, 2
),
results AS (
  SELECT g.strategy, w.month, coalesce(e.month_return, 0.0) AS month_return,
         CAST(coalesce(e.n, 0) AS INTEGER) AS num_assets
  FROM (VALUES {names}) AS g(strategy) CROSS JOIN windows w
  LEFT JOIN earned e ON e.strategy = g.strategy AND e.month = w.month
)"""


def features(keys: str, source: str, name: str) -> str:
    w = f"PARTITION BY {keys} ORDER BY timestamp"
    return f"""
{name}_prev AS (SELECT *, lag(close) OVER ({w}) AS prev FROM {source}),
{name}_lag AS (SELECT *, CASE WHEN close > 0 AND prev > 0 THEN ln(close / prev) END AS log_ret FROM {name}_prev),
{name} AS (
  SELECT *, ma7 / ma30 AS ma_ratio FROM (
    SELECT {keys}, timestamp, close, log_ret,
           lag(log_ret, 1) OVER ({w}) AS ret_lag1, lag(log_ret, 2) OVER ({w}) AS ret_lag2,
           lag(log_ret, 3) OVER ({w}) AS ret_lag3,
           avg(close) OVER ({w} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7,
           avg(close) OVER ({w} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS ma30,
           stddev_samp(log_ret) OVER ({w} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS volatility_7d,
           lead(log_ret) OVER ({w}) AS target
    FROM {name}_lag)
),
{name}_full AS (
  SELECT * FROM {name} WHERE log_ret IS NOT NULL AND ret_lag1 IS NOT NULL AND ret_lag2 IS NOT NULL
    AND ret_lag3 IS NOT NULL AND volatility_7d IS NOT NULL AND target IS NOT NULL AND ma_ratio IS NOT NULL
)"""


def build(*blocks: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",".join(blocks) + "\n" + select
