"""Rebalance calendar and point-in-time holding returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmint.config import Schedule
from panelmint.functions.expressions import bounded_broadcast, finite, month_start
from panelmint.operators.returns import bars_at


def month_sequence(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Calendar months from `first` to `last`, both `yyyy-MM`: `year, month`."""
    steps = F.sequence(F.to_date(F.lit(f"{first}-01")), F.to_date(F.lit(f"{last}-01")), F.expr("interval 1 month"))
    months = spark.range(1).select(F.explode(steps).alias("start"))
    return months.select(F.year("start").alias("year"), F.month("start").alias("month"))


def rebalance_windows(spark: SparkSession, schedule: Schedule) -> DataFrame:
    """`month, lb_start, lb_end, hold_start, hold_end`; all ranges are half open."""
    first = F.lit(schedule.first.replace(day=1))
    start = F.add_months(first, F.col("month") - 1)
    ntz = lambda c: c.cast("timestamp_ntz")
    return spark.range(1, schedule.months + 1).select(F.col("id").cast("int").alias("month")).select(
        "month",
        ntz(F.date_sub(start, schedule.lookback_days)).alias("lb_start"),
        ntz(start).alias("lb_end"),
        ntz(start).alias("hold_start"),
        ntz(F.add_months(start, 1)).alias("hold_end"),
    )


def edge_bars(panel: DataFrame, schedule: Schedule) -> DataFrame:
    """First and last bar of each holding month: `month, symbol, px_start, px_end`, one of them null.

    Only the bars at those exact instants are read; nothing stands in for a missing one.
    """
    starts = schedule.hold_starts
    ends = [*starts[1:], schedule.end]
    hold = month_start(F.col("timestamp"))
    first = F.lit(starts[0].date())
    month = ((F.year(hold) - F.year(first)) * 12 + F.month(hold) - F.month(first) + 1).cast("int")
    bar = F.expr(f"interval {int(schedule.bar.total_seconds())} seconds")
    is_start = F.col("timestamp") == hold.cast("timestamp_ntz")
    is_end = F.col("timestamp") == F.add_months(hold, 1).cast("timestamp_ntz") - bar
    return bars_at(panel, sorted({*starts, *[e - schedule.bar for e in ends]})).select(
        month.alias("month"),
        "symbol",
        F.when(is_start, F.col("close")).alias("px_start"),
        F.when(is_end, F.col("close")).alias("px_end"),
    )


def holding_positions(weights: DataFrame, edges: DataFrame, basket_rows: int | None = None) -> DataFrame:
    """Tradable positions: a start bar is required, a missing end bar means no change in price.

    `basket_rows` bounds the number of weight rows where it is known (strategies x months x top n).
    The bars meet the basket before anything is shuffled, so only its own bars are.
    """
    baskets = weights if basket_rows is None else bounded_broadcast(weights, basket_rows)
    held = (
        edges.join(baskets, ["month", "symbol"])
        .groupBy("strategy", "month", "symbol")
        .agg(
            F.max("weight").alias("weight"),
            F.max("px_start").alias("px_start"),
            F.max("px_end").alias("last_close"),
        )
        .filter(F.col("px_start").isNotNull())
    )
    end = F.coalesce("last_close", "px_start")
    return held.select(
        "strategy", "month", "symbol", "weight", "px_start", end.alias("px_end"),
        F.try_divide(end - F.col("px_start"), F.col("px_start")).alias("ret"),
    )


def holding_returns(
    weights: DataFrame,
    panel: DataFrame,
    schedule: Schedule,
    strategies: list[str],
    price_check: bool = False,
    basket_rows: int | None = None,
) -> DataFrame:
    """Return per strategy and month: `strategy, month, month_return, num_assets`.

    Dividing by the tradable weight renormalises the basket. Every strategy has a row for every
    month; `(0, 0)` where nothing is tradable. With `price_check`, positions with unusable
    prices are dropped after renormalising, so their weight earns nothing.
    """
    held = holding_positions(weights, edge_bars(panel, schedule), basket_rows)
    counts = F.lit(True)
    if price_check:
        counts = finite(F.col("px_start")) & finite(F.col("px_end")) & (F.col("px_start") > 0)
    earned = held.groupBy("strategy", "month").agg(
        F.sum("weight").alias("invested"),
        F.sum(F.when(counts, F.col("weight") * F.col("ret"))).alias("gain"),
        F.count(F.when(counts, F.col("symbol"))).alias("n"),
    )
    earned = earned.filter(F.col("invested") > 0)
    names = F.explode(F.array(*[F.lit(s) for s in strategies]))
    grid = panel.sparkSession.range(1, schedule.months + 1).select(
        names.alias("strategy"), F.col("id").cast("int").alias("month")
    )
    return grid.join(earned, ["strategy", "month"], "left").select(
        "strategy",
        "month",
        F.coalesce(F.col("gain") / F.col("invested"), F.lit(0.0)).alias("month_return"),
        F.coalesce("n", F.lit(0)).cast("int").alias("num_assets"),
    )
