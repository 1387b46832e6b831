"""Train/test splits and the row cap, independent of how the data is partitioned."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmint.functions.expressions import epoch_micros, row_digest

# Hex digits of the digest that form one histogram of the row cap (65,536 cells), and how many
# histograms narrow the cut down before rows are ranked.
CELL_DIGITS = 4
CELL_LEVELS = 2


def with_digest(frame: DataFrame, salt: str) -> DataFrame:
    return frame.withColumn("digest", row_digest(F.lit(salt), F.col("symbol"), epoch_micros(F.col("timestamp"))))


def hash_split(frame: DataFrame, train_share: float) -> DataFrame:
    """Random split by row key: adds `is_train`, true for a `train_share` of all keys."""
    threshold = format(int(train_share * 16**8), "08x")
    digest = F.substring(row_digest(F.col("symbol"), epoch_micros(F.col("timestamp"))), 1, 8)
    return frame.withColumn("is_train", digest < threshold)


def row_cap(frame: DataFrame, cap: int) -> DataFrame:
    """The `cap` rows with the smallest digests: a random sample of exactly that size.

    The digest is salted: it says nothing about the side of `hash_split` a row is on. A histogram
    over digest prefixes (a fixed number of cells) tells which cells fit whole. The one cell that
    straddles the cap is divided the same way by the next digits, and only the rows of the cell
    left open after that, one in four billion, are ranked.
    """
    running = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    rest = with_digest(frame, "cap").withColumn("left", F.lit(cap).cast("long"))
    kept = None
    for level in range(CELL_LEVELS):
        keyed = rest.withColumn("cell", F.substring("digest", 1 + level * CELL_DIGITS, CELL_DIGITS))
        histogram = keyed.groupBy("cell").agg(F.count("*").alias("n"), F.max("left").alias("left"))
        room = (
            histogram.withColumn("room", F.col("left") - F.sum("n").over(running) + F.col("n"))
            .filter(F.col("room") > 0)
            .select("cell", "room", (F.col("n") <= F.col("room")).alias("whole"))
        )
        placed = keyed.join(F.broadcast(room), "cell")  # at most 65,536 cells
        whole = placed.filter("whole").select(frame.columns)
        kept = whole if kept is None else kept.unionByName(whole)
        rest = placed.filter(~F.col("whole")).withColumn("left", F.col("room")).drop("cell", "room", "whole")
    ranked = rest.withColumn("rank", F.row_number().over(Window.partitionBy("left").orderBy("digest")))
    return kept.unionByName(ranked.filter(F.col("rank") <= F.col("left")).select(frame.columns))


def approximate_cut(frame: DataFrame, train_share: float, error: float) -> DataFrame:
    """Per month, a time whose rank is within `error` of the `train_share` quantile, as a share of the month's rows.

    Each task summarises the times it reads; summaries merge by month, so neither rows nor timestamps are sorted or shuffled. A null
    month is a month of its own; a month without times has none.
    """
    if not 0 < error < 1:
        raise ValueError("error is a share of the rows between 0 and 1")
    return frame.groupBy("month").agg(F.percentile_approx("timestamp", train_share, ceil(1 / error)).alias("split_ts"))


def chronological_split(frame: DataFrame, train_share: float, error: float | None = None) -> DataFrame:
    """Per month, rows up to the `train_share` quantile of event time are for training.

    The quantile is exact: rows are first counted per timestamp, and a lookback has few of those. With `error` it comes from
    `approximate_cut`. Adds `split_ts` and `is_train`.
    """
    if error is not None:
        cut = approximate_cut(frame, train_share, error)
        return frame.join(F.broadcast(cut), "month").withColumn("is_train", F.col("timestamp") <= F.col("split_ts"))
    per_stamp = frame.groupBy("month", "timestamp").agg(F.count("*").alias("n"))
    by_time = Window.partitionBy("month").orderBy("timestamp")
    shares = per_stamp.withColumn(
        "seen", F.sum("n").over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("total", F.sum("n").over(Window.partitionBy("month")))
    # Ranks are compared as whole numbers: the smallest timestamp covering the share.
    needed = F.ceil(F.round(F.col("total") * F.lit(train_share), 6))
    cut = (
        shares.filter(F.col("seen") >= needed)
        .groupBy("month")
        .agg(F.min("timestamp").alias("split_ts"))
    )
    # One row per rebalance month.
    return frame.join(F.broadcast(cut), "month").withColumn("is_train", F.col("timestamp") <= F.col("split_ts"))
