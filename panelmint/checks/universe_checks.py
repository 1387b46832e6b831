"""Universe operators over names and volumes taken from the customer and order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmint.checks.registry import query, rounded
from panelmint.functions.expressions import is_leveraged
from panelmint.operators import universe
from panelmint.operators.selection import ranked_top
from panelmint.sources import tables

QUOTE = "USDT"

# A pair name per customer: a leveraged tag for some, another quote for others.
NAMES_SQL = """
pairs AS (
  SELECT c_custkey, c_mktsegment, c_acctbal,
         'C' || c_custkey || CASE c_custkey % 9 WHEN 1 THEN 'UP' WHEN 2 THEN 'DOWN' WHEN 3 THEN 'BULL'
           WHEN 4 THEN 'BEAR' WHEN 5 THEN 'JUP' ELSE '' END
           || CASE WHEN c_custkey % 7 = 3 THEN 'EUR' ELSE 'USDT' END AS symbol
  FROM customer
),
active AS (SELECT symbol FROM pairs WHERE c_mktsegment <> 'MACHINERY' AND symbol LIKE '%USDT'),
volumes AS (
  SELECT symbol, CASE WHEN c_custkey % 11 = 5 THEN 'n/a' ELSE CAST(round(sum(o_totalprice)) AS BIGINT)::VARCHAR END AS volume
  FROM pairs JOIN orders ON o_custkey = c_custkey GROUP BY symbol, c_custkey
),
ranked AS (
  SELECT symbol, try_cast(volume AS DOUBLE) AS quote_volume FROM volumes
  WHERE symbol LIKE '%USDT' AND try_cast(volume AS DOUBLE) IS NOT NULL
)"""

LEVERAGED_SQL = "regexp_matches(symbol, '^(.{2,})?(UP|DOWN|BULL|BEAR)USDT$')"


def _pairs(spark, folder):
    key = F.col("c_custkey")
    tag = (
        F.when(key % 9 == 1, "UP").when(key % 9 == 2, "DOWN").when(key % 9 == 3, "BULL")
        .when(key % 9 == 4, "BEAR").when(key % 9 == 5, "JUP").otherwise("")
    )
    quote = F.when(key % 7 == 3, "EUR").otherwise(QUOTE)
    customers = tables.table(spark, folder, "customer")
    return customers.select(
        "c_custkey", "c_mktsegment", "c_acctbal", F.concat(F.lit("C"), key, tag, quote).alias("symbol")
    )


def _listing(spark, folder):
    return _pairs(spark, folder).select(F.concat(F.lit("data/monthly/"), "symbol", F.lit("/")).alias("prefix"))


def _exchange_info(spark, folder):
    halted = F.col("c_mktsegment") == "MACHINERY"
    return _pairs(spark, folder).select(
        "symbol",
        F.when(halted, "BREAK").otherwise("TRADING").alias("status"),
        F.lit(True).alias("isSpotTradingAllowed"),
        F.regexp_extract("symbol", "(USDT|EUR)$", 1).alias("quoteAsset"),
    )


def _ticker(spark, folder):
    orders = tables.table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.sum("o_totalprice")).cast("bigint").cast("string").alias("total")
    )
    bad = F.col("c_custkey") % 11 == 5
    return orders.join(_pairs(spark, folder), "c_custkey").select(
        "symbol", F.when(bad, "n/a").otherwise(F.col("total")).alias("quoteVolume")
    )


def _seeds(spark, folder):
    """The first customers of each market segment by balance, as seed lists."""
    best = ranked_top(
        _pairs(spark, folder), 4, [F.desc("c_acctbal"), F.asc("c_custkey")], by=("c_mktsegment",)
    )
    return best.select(F.ascii("c_mktsegment").alias("cat_pos"), F.col("rank").alias("pos"), "symbol")


@query(
    "listing_symbols",
    f"WITH {NAMES_SQL} SELECT DISTINCT symbol FROM pairs WHERE symbol LIKE '%USDT' AND NOT {LEVERAGED_SQL}",
)
def listing_symbols(spark, folder):
    return universe.listing_symbols(_listing(spark, folder), QUOTE)


@query(
    "leveraged_filter",
    f"WITH {NAMES_SQL} SELECT symbol, {LEVERAGED_SQL} AS leveraged FROM pairs WHERE symbol LIKE '%USDT'",
)
def leveraged_filter(spark, folder):
    quoted = _pairs(spark, folder).filter(F.col("symbol").endswith(QUOTE))
    return quoted.select("symbol", is_leveraged(F.col("symbol"), QUOTE).alias("leveraged"))


@query("active_symbols", f"WITH {NAMES_SQL} SELECT symbol FROM active")
def active_symbols(spark, folder):
    return universe.active_symbols(_exchange_info(spark, folder), QUOTE)


@query(
    "volume_rank",
    f"""WITH {NAMES_SQL} SELECT symbol, round(quote_volume, 2) AS quote_volume,
        CAST(row_number() OVER (ORDER BY ranked.quote_volume DESC, symbol) AS INTEGER) AS position FROM ranked""",
)
def volume_rank(spark, folder):
    ranked = universe.volume_positions(universe.volume_ranked(_ticker(spark, folder), QUOTE))
    return rounded(ranked, "quote_volume", digits=2)


@query(
    "volume_rank_zero",
    f"""WITH {NAMES_SQL} SELECT symbol, round(coalesce(try_cast(volume AS DOUBLE), 0), 2) AS quote_volume
        FROM volumes WHERE symbol LIKE '%USDT'""",
)
def volume_rank_zero(spark, folder):
    ranked = universe.volume_ranked(_ticker(spark, folder), QUOTE, zero_unparsed=True)
    return rounded(ranked, "quote_volume", digits=2)


DIVERSIFIED_SQL = f"""WITH {NAMES_SQL},
seeds AS (
  SELECT symbol, ascii(c_mktsegment) AS cat_pos,
         row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS pos
  FROM pairs QUALIFY pos <= 4
),
offers AS (
  SELECT symbol, 0 AS tier, cat_pos, pos, 0.0 AS v FROM seeds
  UNION ALL SELECT symbol, 1, 0, 0, -quote_volume FROM ranked
  UNION ALL SELECT symbol, 2, 0, 0, 0.0 FROM active
),
firsts AS (
  SELECT * FROM offers WHERE symbol IN (SELECT symbol FROM active)
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY tier, cat_pos, pos, v) = 1
)
SELECT CAST(row_number() OVER (ORDER BY tier, cat_pos, pos, v, symbol) AS INTEGER) AS position, symbol
FROM firsts ORDER BY position LIMIT 300"""


@query("diversified_universe", DIVERSIFIED_SQL)
def diversified_universe(spark, folder):
    ranked = universe.volume_ranked(_ticker(spark, folder), QUOTE)
    active = universe.active_symbols(_exchange_info(spark, folder), QUOTE)
    return universe.diversified_universe(_seeds(spark, folder), ranked, active, 300)


@query("historical_universe", f"WITH {NAMES_SQL} SELECT DISTINCT symbol FROM pairs WHERE symbol LIKE '%USDT'")
def historical_universe(spark, folder):
    return universe.resolve_universe(
        "historical-usdt", QUOTE, fallback=_pairs(spark, folder).select("symbol"),
        listing=_listing(spark, folder), include_leveraged=True,
    )


def _resolved(spark, folder, mode, **sources):
    return universe.resolve_universe(mode, QUOTE, fallback=_pairs(spark, folder).select("symbol"), **sources)


@query("top100_universe", f"WITH {NAMES_SQL} SELECT symbol FROM pairs WHERE symbol LIKE '%USDT'")
def top100_universe(spark, folder):
    return _resolved(spark, folder, "top100", exchange_info=_exchange_info(spark, folder))


@query("all_usdt_universe", f"WITH {NAMES_SQL} SELECT symbol FROM active")
def all_usdt_universe(spark, folder):
    return _resolved(spark, folder, "ALL-usdt", exchange_info=_exchange_info(spark, folder))


@query("universe_fallthrough", f"WITH {NAMES_SQL} SELECT symbol FROM pairs WHERE symbol LIKE '%USDT'")
def universe_fallthrough(spark, folder):
    """Without a listing and without exchange data the fixed list is what is left."""
    return _resolved(spark, folder, "historical-usdt")
