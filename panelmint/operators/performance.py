"""Equity curves and performance tables. A strategy has one row per rebalance month."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelmint.config import Schedule, Settings


def so_far() -> WindowSpec:
    return Window.partitionBy("strategy").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)


def equity_curve(results: DataFrame, settings: Settings, with_start: bool = True) -> DataFrame:
    """`strategy, month, portfolio_value`; month 0 is the initial capital.

    The first month of a strategy yields two rows, so the results are evaluated once.
    """
    capital = F.lit(settings.initial_capital)
    curve = results.select(
        "strategy", "month", (capital * F.product(1 + F.col("month_return")).over(so_far())).alias("portfolio_value")
    )
    if not with_start:
        return curve
    here = F.struct(F.col("month").alias("month"), F.col("portfolio_value").alias("portfolio_value"))
    start = F.struct(F.lit(0).alias("month"), capital.alias("portfolio_value"))
    first = F.row_number().over(Window.partitionBy("strategy").orderBy("month")) == 1
    points = F.when(first, F.array(start, here)).otherwise(F.array(here))
    return (
        curve.withColumn("points", points)
        .select("strategy", F.explode("points").alias("point"))
        .select("strategy", "point.month", "point.portfolio_value")
    )


def drawdowns(equity: DataFrame) -> DataFrame:
    """Running peak and the loss since it."""
    peak = F.max("portfolio_value").over(so_far())
    return equity.withColumn("peak", peak).withColumn(
        "drawdown", (F.col("portfolio_value") - F.col("peak")) / F.col("peak")
    )


def return_table(results: DataFrame, months: int) -> DataFrame:
    """Strategies by months, in percent."""
    wide = (
        results.groupBy("strategy")
        .pivot("month", list(range(1, months + 1)))
        .agg(F.first(F.col("month_return") * 100))
    )
    return wide.select("strategy", *[F.col(str(m)).alias(f"m{m:02d}") for m in range(1, months + 1)])


def performance(results: DataFrame, settings: Settings, compound: bool = True) -> DataFrame:
    """One line per strategy. Volatility is the population deviation of monthly returns.

    The peak starts at the initial capital, as in a curve with month 0.
    """
    capital = F.lit(settings.initial_capital)
    curve = results.withColumn("value", capital * F.product(1 + F.col("month_return")).over(so_far()))
    peak = F.greatest(capital, F.max("value").over(so_far()))
    growth = (
        curve.withColumn("peak", peak)
        .groupBy("strategy")
        .agg(
            F.product(1 + F.col("month_return")).alias("growth"),
            F.count("*").alias("n"),
            F.stddev_pop("month_return").alias("deviation"),
            F.avg(F.when(F.col("month_return") > 0, 1.0).otherwise(0.0)).alias("win_rate"),
            F.min((F.col("value") - F.col("peak")) / F.col("peak")).alias("worst"),
        )
    )
    monthly = F.pow(F.col("growth"), 1 / F.col("n")) - 1
    annual = F.pow(1 + monthly, F.lit(12)) - 1 if compound else monthly * 12
    return (
        growth.withColumn("final_value", capital * F.col("growth"))
        .withColumn("total_return", (F.col("final_value") - capital) / capital)
        .withColumn("ann_return", annual)
        .withColumn("ann_volatility", F.col("deviation") * F.lit(math.sqrt(12)))
        .withColumn(
            "sharpe",
            F.when(F.col("ann_volatility") > 0, F.try_divide("ann_return", "ann_volatility")).otherwise(0.0),
        )
        .withColumn("max_drawdown", F.least(F.lit(0.0), F.col("worst")))
        .select(
            "strategy", "total_return", "ann_return", "ann_volatility", "sharpe", "max_drawdown", "win_rate", "final_value"
        )
    )


def best_strategy(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("sharpe"), F.asc("strategy")).limit(1)


def report_lines(table: DataFrame) -> DataFrame:
    """The performance table as text: currency, signed percentages, plain percentages."""

    def percent(name: str, pattern: str) -> Column:
        return F.format_string(pattern, F.col(name) * 100).alias(name)

    return table.select(
        "strategy",
        F.format_string("$%,.0f", "final_value").alias("final_value"),
        percent("total_return", "%+.2f%%"),
        percent("ann_return", "%+.2f%%"),
        percent("ann_volatility", "%.2f%%"),
        F.format_string("%.2f", "sharpe").alias("sharpe"),
        percent("max_drawdown", "%.2f%%"),
        percent("win_rate", "%.1f%%"),
    )


def labelled_results(results: DataFrame, schedule: Schedule) -> DataFrame:
    """Monthly results with the month's name, e.g. `Jan 2025`."""
    start = F.add_months(F.lit(schedule.first.replace(day=1)), F.col("month") - 1)
    return results.withColumn("label", F.date_format(start, "MMM yyyy"))
