"""Loads that add to the lake: only the months they touch are rewritten, and a manifest keeps what each file holds."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmint.sources.lake import CANDLE, partition_columns, read_lake

KEY = ["year", "month", "symbol", "timestamp"]


def manifest_path(lake: str) -> str:
    return lake.rstrip("/") + ".manifest"


def read_manifest(spark: SparkSession, lake: str) -> DataFrame:
    """`file, file_bytes, symbol, rows, first_bar, last_bar, year, month`: a row per file and symbol."""
    return spark.read.parquet(manifest_path(lake))


def merge_lake(candles: DataFrame, path: str) -> list[tuple[int, int]]:
    """Add candles to the lake and return the months rewritten.

    A bar is known by symbol and timestamp. One that is loaded again replaces the stored one; of equal keys in one load the greatest
    values stay, so the result depends on no order. Bars without a close or a time are left out. Months without new bars keep their files.

    Rows of a month meet by symbol and timestamp, so a symbol that owns a third of them is spread over all tasks. The new files
    replace the old ones when the whole job is done; a load that dies before leaves the lake as it was. The manifest follows in
    a job of its own; `manifest_faults` tells if that one was lost, and merging any load again, or `write_manifest`, mends it. One load at a time.
    """
    spark = candles.sparkSession
    fresh = partition_columns(candles.filter(F.col("close").isNotNull() & F.col("timestamp").isNotNull())).select(*CANDLE, "year", "month")
    months = sorted((r["year"], r["month"]) for r in fresh.select("year", "month").distinct().collect())  # the calendar's length
    if not months:
        return []
    rows = fresh.withColumn("load", F.lit(1))
    stored = _stored(spark, path)
    if stored is not None:
        rows = rows.unionByName(stored.filter(_within(months)).select(*CANDLE, "year", "month").withColumn("load", F.lit(0)))
    values = [c for c in CANDLE if c not in KEY]
    latest = rows.groupBy(*KEY).agg(F.max(F.struct("load", *values)).alias("bar")).select(*KEY, *[F.col("bar")[c].alias(c) for c in values])
    even = latest.select(*CANDLE, "year", "month").hint("rebalance", F.col("year"), F.col("month"))
    _replace(even, path)
    known = stored is not None and _has_manifest(spark, path)
    write_manifest(spark, path, months if known or stored is None else None)
    return months


def write_manifest(spark: SparkSession, path: str, months: list[tuple[int, int]] | None = None) -> None:
    """Describe the files of these months, of all where none are given, from one pass over their symbols and times."""
    spark.catalog.refreshByPath(path)
    bars = read_lake(spark, path)
    if months is not None:
        bars = bars.filter(_within(months))
    files = bars.groupBy("year", "month", _place("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_bytes"), "symbol").agg(
        F.count("*").alias("rows"), F.min("timestamp").alias("first_bar"), F.max("timestamp").alias("last_bar")
    )
    if months is None:
        files.write.mode("overwrite").partitionBy("year", "month").parquet(manifest_path(path))
    else:
        _replace(files, manifest_path(path))
    spark.catalog.refreshByPath(manifest_path(path))


def manifest_totals(spark: SparkSession, path: str) -> DataFrame:
    """The lake's verification, `year, month, rows, symbols` with a line (0, 0) for all, without a look at its bars."""
    cells = read_manifest(spark, path).groupBy("year", "month", "symbol").agg(F.sum("rows").alias("rows"))
    sums = [F.sum("rows").alias("rows"), F.count("symbol").alias("symbols")]
    symbols = cells.groupBy("symbol").agg(F.sum("rows").alias("rows"))
    return cells.groupBy("year", "month").agg(*sums).unionByName(symbols.agg(*sums).select(F.lit(0).alias("year"), F.lit(0).alias("month"), "rows", "symbols"))


def manifest_faults(spark: SparkSession, path: str) -> DataFrame:
    """`file, fault` where lake and manifest differ: a file is `missing`, `unknown` or of another `size`. Files are listed, not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    found = listed.select(_place("path").alias("file"), F.col("length").alias("found_bytes"))
    named = read_manifest(spark, path).groupBy("file").agg(F.max("file_bytes").alias("named_bytes"))
    fault = (
        F.when(F.col("found_bytes").isNull(), "missing")
        .when(F.col("named_bytes").isNull(), "unknown")
        .when(F.col("found_bytes") != F.col("named_bytes"), "size")
    )
    return named.join(found, "file", "full").select("file", fault.alias("fault")).filter("fault IS NOT NULL")


def _place(path: str) -> Column:
    """A file's place in the lake, `year=2025/month=1/part-...`: one task gives the same name to its files of several months."""
    return F.substring_index(path, "/", -3)


def _replace(rows: DataFrame, path: str) -> None:
    """Replace the months that have rows; others keep their files."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)


def _within(months: list[tuple[int, int]]) -> Column:
    """A condition on the partition columns alone: files of other months are not opened."""
    return (F.col("year") * 100 + F.col("month")).isin([100 * year + month for year, month in months])


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    spark.catalog.refreshByPath(path)
    try:
        return read_lake(spark, path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _has_manifest(spark: SparkSession, path: str) -> bool:
    return _stored(spark, manifest_path(path)) is not None
