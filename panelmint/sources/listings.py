"""Exchange listings and tickers as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXCHANGE_SCHEMA = (
    "symbols array<struct<symbol: string, status: string, isSpotTradingAllowed: boolean, quoteAsset: string>>"
)
TICKER_SCHEMA = "symbol string, quoteVolume string"


def read_exchange_info(spark: SparkSession, path: str) -> DataFrame:
    """One row per listed symbol from exchange-info JSON."""
    info = spark.read.schema(EXCHANGE_SCHEMA).option("multiLine", True).json(path)
    return info.select(F.explode("symbols").alias("s")).select("s.*")


def read_ticker(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TICKER_SCHEMA).option("multiLine", True).json(path)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Archive listing, one prefix per line."""
    return spark.read.text(path).withColumnRenamed("value", "prefix")
