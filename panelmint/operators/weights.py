"""Basket weights: `month, symbol, weight`, summing to 1 per month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from panelmint.config import Schedule, Settings
from panelmint.functions.expressions import valid_risk
from panelmint.operators.selection import ranked_top, top_sharpe


def in_basket() -> WindowSpec:
    """One month's chosen basket: at most `top_n` rows."""
    return Window.partitionBy("month")


def share_of_total(frame: DataFrame, value: str, name: str = "weight") -> DataFrame:
    return frame.withColumn(name, F.try_divide(F.col(value), F.sum(value).over(in_basket())))


def inverse_vol_weights(basket: DataFrame) -> DataFrame:
    """Weights in proportion to `1 / annual_vol`; unusable risk numbers are left out."""
    usable = basket.filter(valid_risk(F.col("annual_vol"), F.col("sharpe")))
    return share_of_total(usable.withColumn("inv_vol", 1 / F.col("annual_vol")), "inv_vol").drop("inv_vol")


def weight_percent(basket: DataFrame) -> DataFrame:
    return basket.withColumn("weight_pct", F.round(F.col("weight") * 100, 2))


def fallback_weights(metrics: DataFrame, settings: Settings) -> DataFrame:
    """Plain basket: best Sharpe ratios, inverse-volatility weights."""
    usable = metrics.filter(valid_risk(F.col("annual_vol"), F.col("sharpe")))
    return inverse_vol_weights(top_sharpe(usable, settings.top_n)).select("month", "symbol", "weight")


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """`primary`, and `fallback` for the months in which `primary` has nothing. Each is evaluated once."""
    columns = ["month", "symbol", "weight"]
    tagged = primary.select(*columns, F.lit(0).alias("tier")).unionByName(fallback.select(*columns, F.lit(1).alias("tier")))
    best = F.min("tier").over(in_basket())
    return tagged.withColumn("best", best).filter(F.col("tier") == F.col("best")).select(columns)


def forecast_weights(predictions: DataFrame, settings: Settings) -> DataFrame:
    """Top predictions, shifted so that the lowest one keeps a small positive weight."""
    top = ranked_top(predictions, settings.top_n, [F.desc("prediction"), F.asc("symbol")])
    lowest = F.min("prediction").over(in_basket())
    shifted = top.withColumn("shifted", F.col("prediction") - lowest + settings.prediction_floor)
    return share_of_total(shifted, "shifted").select("month", "symbol", "prediction", "weight")


def benchmark_weights(spark: SparkSession, symbol: str, schedule: Schedule) -> DataFrame:
    """One symbol with weight 1 in every month."""
    return spark.range(1, schedule.months + 1).select(
        F.col("id").cast("int").alias("month"), F.lit(symbol).alias("symbol"), F.lit(1.0).alias("weight")
    )
