"""The candle lake: a Parquet folder partitioned by year and month."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmint.sources.klines import read_processed

# The columns of the lake.
CANDLE = ["timestamp", "symbol", "open", "high", "low", "close", "volume"]


def partition_columns(candles: DataFrame) -> DataFrame:
    return candles.withColumn("year", F.year("timestamp")).withColumn("month", F.month("timestamp"))


def write_lake(candles: DataFrame, path: str) -> None:
    """Replace the lake. Rows are rebalanced by month: small months share a task and a large one
    is split by size, so files come out even whatever a month or a symbol holds."""
    rows = partition_columns(candles.filter(F.col("close").isNotNull())).select(*CANDLE, "year", "month")
    even = rows.hint("rebalance", F.col("year"), F.col("month"))
    even.write.mode("overwrite").partitionBy("year", "month").parquet(path)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_candles(spark: SparkSession, lake: str, csv: str, quote: str | None = None) -> DataFrame:
    """The lake if it has data, else the processed CSV files, else FileNotFoundError."""
    for read in (lambda: read_lake(spark, lake), lambda: read_processed(spark, csv, quote)):
        try:
            return read()
        except AnalysisException as problem:
            if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    raise FileNotFoundError(f"no candles in {lake} or {csv}")


def price_panel(candles: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The long panel `timestamp, symbol, close`; bars without a close are left out.

    A zero or negative close stays: it is a bar, and both returns that touch it are undefined.
    """
    return candles.select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "symbol",
        F.col("close").cast("double").alias("close"),
        *keep,
    ).filter(F.col("close").isNotNull())
