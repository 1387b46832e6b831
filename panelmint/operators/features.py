"""Rolling features for the forecast models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmint.config import Schedule, Settings
from panelmint.functions.expressions import log_ratio
from panelmint.operators.returns import chunked_bars, lookback_bars

# The names of the features.
FEATURES = ["ret_lag1", "ret_lag2", "ret_lag3", "ma_ratio", "volatility_7d"]

# Rows a feature looks back over (the long average) and ahead (the target).
ROWS_BACK = 30
ROWS_AHEAD = 1


def feature_columns(bars: DataFrame, series: list[str]) -> DataFrame:
    """Lagged returns, average ratio, volatility and next return; one sort per series."""
    w = Window.partitionBy(*series).orderBy("timestamp")
    return (
        bars.withColumn("log_ret", log_ratio(F.col("close"), F.lag("close").over(w)))
        .withColumns(
            {
                "ret_lag1": F.lag("log_ret", 1).over(w),
                "ret_lag2": F.lag("log_ret", 2).over(w),
                "ret_lag3": F.lag("log_ret", 3).over(w),
                "ma7": F.avg("close").over(w.rowsBetween(-6, 0)),
                "ma30": F.avg("close").over(w.rowsBetween(-29, 0)),
                "volatility_7d": F.stddev_samp("log_ret").over(w.rowsBetween(-6, 0)),
                "target": F.lead("log_ret", 1).over(w),
            }
        )
        .withColumn("ma_ratio", F.try_divide("ma7", "ma30"))
    )


def with_row_blocks(panel: DataFrame, settings: Settings) -> DataFrame:
    """Cut each series into blocks of `chunk_bars` rows, with copies of the rows around a cut.

    Adds `block` and `is_core`. A row's position in its series is its rank inside its chunk of
    the time grid plus the rows in earlier chunks, so no task ever sorts a whole history. Row
    windows of up to ROWS_BACK back and ROWS_AHEAD ahead are exact on the core rows of a block.
    """
    size = settings.chunk_bars
    bars = chunked_bars(panel, settings)
    earlier = Window.partitionBy("symbol").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        # Counted on the map side, so this branch shuffles chunks, not bars.
        bars.groupBy("symbol", "chunk")
        .agg(F.count("*").alias("n"))
        .select("symbol", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("symbol", "chunk").orderBy("timestamp")
    placed = (
        bars.withColumn("rank", F.row_number().over(inside))
        .join(offsets, ["symbol", "chunk"], "left")
        .withColumn("position", F.col("offset") + F.col("rank") - 1)
        .withColumn("home", F.floor(F.col("position") / size))
    )
    place = F.col("position") % size
    copies = F.array_compact(
        F.array(
            F.col("home"),
            F.when(place >= size - ROWS_BACK, F.col("home") + 1),
            F.when((place < ROWS_AHEAD) & (F.col("home") > 0), F.col("home") - 1),
        )
    )
    return placed.select("symbol", "timestamp", "close", "home", F.explode(copies).alias("block")).withColumn(
        "is_core", F.col("block") == F.col("home")
    )


def rolling_features(panel: DataFrame, settings: Settings) -> DataFrame:
    """Features of every bar over its symbol's whole history."""
    return (
        feature_columns(with_row_blocks(panel, settings), ["symbol", "block"])
        .filter("is_core")
        .select("symbol", "timestamp", "close", "log_ret", *FEATURES, "ma7", "ma30", "target")
    )


def forecast_frame(panel: DataFrame, settings: Settings) -> DataFrame:
    """Complete feature rows only."""
    return rolling_features(panel, settings).na.drop().select("symbol", "timestamp", *FEATURES, "target")


def windowed_forecast_frame(panel: DataFrame, schedule: Schedule) -> DataFrame:
    """The same features restarted inside each lookback window."""
    bars = feature_columns(lookback_bars(panel, schedule), ["month", "symbol"])
    return bars.na.drop().select("month", "symbol", "timestamp", *FEATURES, "target")
