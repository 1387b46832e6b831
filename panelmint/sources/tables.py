"""Price panels from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_bars(spark: SparkSession, folder: str) -> DataFrame:
    """4-hour bars per user; the close is the last value in the bar.

    The last value per bar is kept on the map side, so a user with many events sends one row
    per bar and task.
    """
    events = table(spark, folder, "events")
    return (
        events.groupBy(F.window("ts", "4 hours").start.alias("timestamp"), F.col("user_id").cast("string").alias("symbol"))
        .agg(F.max_by("value", "ts").alias("close"))
        .filter(F.col("close").isNotNull())
    )


def part_bars(spark: SparkSession, folder: str, label: str) -> DataFrame:
    """Daily bars per part attribute; the close is the mean unit price shipped that day.

    Large sides are joined by Spark's own choice; its skew handling splits a part that owns many
    lines, and sums per day and label are combined before the second shuffle.
    """
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col(label).alias("symbol"))
    return (
        lines.join(parts, "l_partkey")
        .groupBy(F.col("l_shipdate").alias("timestamp"), "symbol")
        .agg(F.try_divide(F.sum("l_extendedprice"), F.sum("l_quantity")).alias("close"))
        .filter(F.col("close").isNotNull())
    )
