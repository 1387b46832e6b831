"""Result tables as CSV, and small in-memory inputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(report: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """One CSV file with a header. For report tables: a line per basket member, month or component.

    The rows move to one task after they are computed, not before."""
    chosen = report.select(*columns) if columns else report
    chosen.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def weights_from_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """A basket given by hand; no rows give an empty basket of the same type."""
    return spark.createDataFrame(list(rows), "month int, symbol string, weight double")


def component_report(variance: DataFrame) -> DataFrame:
    """`component (PC1, PC2, ...), explained_variance, cumulative_variance`."""
    return variance.orderBy("component").select(
        F.concat(F.lit("PC"), F.col("component")).alias("component"), "explained_variance", "cumulative_variance"
    )
