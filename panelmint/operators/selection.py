"""Choosing symbols. Ties are broken by symbol, so every choice is reproducible.

Rankings are written as `row_number() <= n`: below `spark.sql.optimizer.windowGroupLimitThreshold` Spark cuts each map
partition down to its own top `n` before the shuffle, so a month with any number of symbols sends only `n` rows per
task. Without a limit the ranking is distributed (ranking.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.functions.expressions import valid_risk
from panelmint.operators.metrics import observation_counts
from panelmint.operators.ranking import distributed_rank


def ranked_top(frame: DataFrame, n: int | None, order: list[Column], by: tuple[str, ...] = ("month",)) -> DataFrame:
    """First `n` rows per group in the given order, with their `rank` from 1. All of them without `n`, ranked by ranges."""
    if n is None:
        return distributed_rank(frame, order, by)
    return frame.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= n)


def as_members(ranked: DataFrame) -> DataFrame:
    """Turn the rank into a matrix position `ord` from 0 and add the member count `size`."""
    sizes = ranked.groupBy("month").agg(F.count("*").cast("int").alias("size"))  # one line per month
    return ranked.withColumn("ord", (F.col("rank") - 1).cast("int")).join(F.broadcast(sizes), "month")


def universe_cap(panel: DataFrame, settings: Settings) -> DataFrame:
    """All symbols, or the `max_symbols` with most bars: `month (0), symbol, n_obs, rank`."""
    counts = observation_counts(panel).withColumn("month", F.lit(0))
    return ranked_top(counts, settings.max_symbols, [F.desc("n_obs"), F.asc("symbol")])


def candidate_cap(metrics: DataFrame, settings: Settings) -> DataFrame:
    """Per month the symbols with usable risk numbers, best Sharpe ratio first; `max_symbols` of them if that is set."""
    usable = metrics.filter(valid_risk(F.col("annual_vol"), F.col("sharpe")))
    return ranked_top(usable, settings.max_symbols, [F.desc("sharpe"), F.asc("symbol")])


def top_sharpe(metrics: DataFrame, n: int, by: tuple[str, ...] = ("month",)) -> DataFrame:
    known = metrics.filter(F.col("sharpe").isNotNull() & ~F.isnan("sharpe"))
    return ranked_top(known, n, [F.desc("sharpe"), F.asc("symbol")], by)


def best_symbols(metrics: DataFrame, n: int) -> DataFrame:
    """Top `n` by Sharpe over one static table."""
    known = metrics.filter(F.col("sharpe").isNotNull() & ~F.isnan("sharpe"))
    return known.orderBy(F.desc("sharpe"), F.asc("symbol")).limit(n)


def group_leaders(grouped: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Best Sharpe ratio of each group."""
    return top_sharpe(grouped, 1, by).drop("rank")


def round_robin(grouped: DataFrame, n: int, group: str = "cluster") -> DataFrame:
    """Take the best of every group, then the second best of every group, until `n` are chosen.

    Taking turns in group order is the order (rank in group, group). No group can supply more
    than `n`, so ranks beyond `n` are cut before the second ranking.
    """
    in_group = top_sharpe(grouped, n, ("month", group)).withColumnRenamed("rank", "group_rank")
    return ranked_top(in_group, n, [F.asc("group_rank"), F.asc(group)])


def top_residual(scored: DataFrame, settings: Settings) -> DataFrame:
    return ranked_top(scored, settings.top_n, [F.desc("residual_score"), F.asc("symbol")])


def top_prediction(predictions: DataFrame, settings: Settings) -> DataFrame:
    return ranked_top(predictions, settings.top_n, [F.desc("prediction"), F.asc("symbol")])
