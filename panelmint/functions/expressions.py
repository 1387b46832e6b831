"""Column expressions shared by the operators. All of them stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Epoch magnitudes that tell microseconds and milliseconds from seconds.
MICROS_FROM = 10**15
MILLIS_FROM = 10**12

# Name tags of leveraged products.
LEVERAGE_TAGS = ("UP", "DOWN", "BULL", "BEAR")


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_to_timestamp(epoch: Column) -> Column:
    """Read one epoch number as s, ms or us, judged by its own size."""
    return (
        F.when(epoch >= MICROS_FROM, F.timestamp_micros(epoch))
        .when(epoch >= MILLIS_FROM, F.timestamp_millis(epoch))
        .otherwise(F.timestamp_seconds(epoch))
        .cast("timestamp_ntz")
    )


def month_index(year: Column, month: Column, base_year: int) -> Column:
    """Months since December of the year before `base_year`: January of it is 1."""
    return ((year - F.lit(base_year)) * 12 + month).cast("int")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "MM")


def log_ratio(value: Column, previous: Column) -> Column:
    """Log of the ratio of two prices; null unless both are positive."""
    return F.when((value > 0) & (previous > 0), F.ln(F.try_divide(value, previous)))


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def valid_risk(vol: Column, sharpe: Column) -> Column:
    return finite(vol) & (vol > 0) & finite(sharpe)


def is_leveraged(symbol: Column, quote: str) -> Column:
    """The base is a bare tag, or a tag behind a stem of two characters or more."""
    return symbol.rlike(f"^(.{{2,}})?({'|'.join(LEVERAGE_TAGS)}){quote}$")


def with_chunk(panel: DataFrame, chunk_micros: int) -> DataFrame:
    """Add `chunk`, the stretch of the time grid a bar falls into."""
    micros = epoch_micros(F.col("timestamp"))
    return panel.withColumn("chunk", F.floor(micros / F.lit(chunk_micros)))


def row_digest(*columns: Column) -> Column:
    """Hex digest of a row key: an order and a split that do not depend on partitioning."""
    return F.md5(F.concat_ws("|", *columns))


def bounded_broadcast(frame: DataFrame, rows_at_most: int | None, limit: int = 200_000) -> DataFrame:
    """Broadcast a frame whose row count has a known bound; otherwise leave the choice to Spark."""
    return F.broadcast(frame) if rows_at_most is not None and rows_at_most <= limit else frame
