"""Symbol universes from listing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmint.functions.expressions import is_leveraged
from panelmint.operators.ranking import distributed_rank

# The names of the modes.
MODES = ("top100", "diversified", "all-usdt", "historical-usdt")


def listing_symbols(listing: DataFrame, quote: str, include_leveraged: bool = False) -> DataFrame:
    """Symbols named by the last path segment of each `prefix`, once each."""
    symbol = F.element_at(F.split(F.rtrim(F.col("prefix"), F.lit("/")), "/"), -1)
    symbols = listing.select(symbol.alias("symbol")).filter(F.col("symbol").endswith(quote))
    if not include_leveraged:
        symbols = symbols.filter(~is_leveraged(F.col("symbol"), quote))
    return symbols.distinct()


def active_symbols(exchange_info: DataFrame, quote: str) -> DataFrame:
    """Symbols that trade spot against the quote, from one row per listed symbol."""
    return exchange_info.filter(
        (F.col("status") == "TRADING") & F.col("isSpotTradingAllowed") & (F.col("quoteAsset") == quote)
    ).select("symbol")


def volume_ranked(ticker: DataFrame, quote: str, zero_unparsed: bool = False) -> DataFrame:
    """`symbol, quote_volume` of the quote's pairs, in no order; volume_positions() ranks them.

    A volume that is no number drops its row, or counts as 0 with `zero_unparsed`. An absent
    volume is 0 either way.
    """
    given = F.coalesce(F.col("quoteVolume"), F.lit("0"))
    volume = F.col("quote_volume")
    parsed = ticker.filter(F.col("symbol").endswith(quote)).select(
        "symbol", given.try_cast("double").alias("quote_volume")
    )
    if zero_unparsed:
        parsed = parsed.withColumn("quote_volume", F.coalesce(volume, F.lit(0.0)))
    return parsed.filter(volume.isNotNull())


def volume_positions(ranked: DataFrame) -> DataFrame:
    """Adds `position` from 1, largest volume first."""
    return distributed_rank(ranked, [F.desc("quote_volume"), F.asc("symbol")], name="position").withColumn("position", F.col("position").cast("int"))


def diversified_universe(
    seeds: DataFrame, ranked: DataFrame, active: DataFrame, target: int, cap_to_active: bool = True
) -> DataFrame:
    """Up to `target` active symbols: seeds by category, then by volume, then by name.

    A symbol offered more than once keeps its earliest place. `seeds` has `cat_pos, pos, symbol`.
    Returns `position, symbol`.
    """
    no_volume = F.lit(0.0)
    offers = (
        seeds.select("symbol", F.struct(F.lit(0).alias("tier"), "cat_pos", "pos", no_volume.alias("volume")).alias("place"))
        .unionByName(
            ranked.select(
                "symbol",
                F.struct(
                    F.lit(1).alias("tier"), F.lit(0).alias("cat_pos"), F.lit(0).alias("pos"),
                    (-F.col("quote_volume")).alias("volume"),
                ).alias("place"),
            )
        )
        .unionByName(
            active.select(
                "symbol",
                F.struct(
                    F.lit(2).alias("tier"), F.lit(0).alias("cat_pos"), F.lit(0).alias("pos"), no_volume.alias("volume")
                ).alias("place"),
            )
        )
    )
    placed = (
        offers.groupBy("symbol")
        .agg(F.min("place").alias("place"))
        .join(active.select("symbol"), "symbol", "left_semi")
        .orderBy("place", "symbol")
        .limit(max(1, target))
    )
    # At most `target` rows are left to number.
    return placed.select(F.row_number().over(Window.orderBy("place", "symbol")).alias("position"), "symbol")


def resolve_universe(
    mode: str,
    quote: str,
    *,
    fallback: DataFrame,
    listing: DataFrame | None = None,
    exchange_info: DataFrame | None = None,
    ticker: DataFrame | None = None,
    seeds: DataFrame | None = None,
    target: int = 300,
    include_leveraged: bool = False,
) -> DataFrame:
    """Universe for a mode; a source that is not available falls through to the next one."""
    mode = mode.lower()
    if mode not in MODES:
        raise ValueError(f"unknown universe mode: {mode}")
    static = fallback.filter(F.col("symbol").endswith(quote)).select("symbol")
    if mode == "top100":
        return static
    if mode == "historical-usdt" and listing is not None:
        return listing_symbols(listing, quote, include_leveraged)
    if exchange_info is None:
        return static
    active = active_symbols(exchange_info, quote)
    if mode == "all-usdt":
        return active
    if mode == "diversified" and seeds is not None and ticker is not None:
        return diversified_universe(seeds, volume_ranked(ticker, quote), active, target).select("symbol")
    return static
