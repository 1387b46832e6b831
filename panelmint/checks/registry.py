"""Named queries, each with the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmint.config import Schedule, Settings
from panelmint.plans.static_models import StaticModels
from panelmint.plans.walk_forward import WalkForward
from panelmint.session import use_utc
from panelmint.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# 4-hour event bars: short chunks, so that the checks cross chunk and block borders; a threshold
# that some pairs of this weakly correlated data reach.
EVENTS = Settings(theta=0.25, chunk_bars=64)

# Daily brand bars, rebalanced monthly through 1997.
DAY = timedelta(days=1)
BRANDS = Settings(bar=DAY, periods_per_year=365, min_obs=30, theta=0.3, top_n=8)
YEAR = Schedule(first=date(1997, 1, 1), months=12, lookback_days=90, bar=DAY)
# All months that have a full lookback and a full holding month.
SPAN = Schedule(first=date(1995, 5, 1), months=78, lookback_days=90, bar=DAY)
BENCHMARK = "Brand#1"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL twin if there is one."""

    def register(run: Query) -> Query:
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            return run(use_utc(spark), folder)

        QUERIES[name] = prepared
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def rounded(frame: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


def events(spark: SparkSession, folder: str) -> DataFrame:
    return tables.event_bars(spark, folder)


def static(spark: SparkSession, folder: str) -> StaticModels:
    return StaticModels(events(spark, folder), EVENTS)


def brands(spark: SparkSession, folder: str) -> DataFrame:
    return tables.part_bars(spark, folder, "p_brand")


def brand_year(spark: SparkSession, folder: str) -> WalkForward:
    return WalkForward(brands(spark, folder), YEAR, BRANDS, BENCHMARK)
