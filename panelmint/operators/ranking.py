"""Ranks of all rows without a group, or the whole table, in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmint.session import written_once


def distributed_rank(frame: DataFrame, order: list[Column], by: tuple[str, ...] = (), name: str = "rank") -> DataFrame:
    """Adds `name`: the number of a row from 1 in its group's order, as `row_number()` gives it, whatever a group's size.

    Rows are dealt by ranges of (group, order) with sampled bounds, so a large group spans many tasks, and are written to the
    checkpoint folder with their task and place. A task's rows of a group are numbered from their place; what earlier tasks hold of the
    group comes from a table with one row per task and group. `order` should be a total one: rows that tie are numbered as they were written.
    Null groups count as one group.
    """
    ascending = [F.asc_nulls_first(c) for c in by]
    dealt = frame.repartitionByRange(*ascending, *order).sortWithinPartitions(*ascending, *order)
    placed = written_once(dealt.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}))
    runs = placed.groupBy(*by, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__held"))
    if by:
        earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("__held").over(earlier), F.lit(0))
        ranked = runs.withColumn("__shift", before - F.col("__first") + 1).drop("__first", "__held")
        met = [placed[c].eqNullSafe(ranked[c]) for c in (*by, "__part")]
        joined = placed.join(ranked, met).drop(*[ranked[c] for c in (*by, "__part")])
    else:
        # One row per task: as many as there are shuffle partitions.
        counts = sorted((r["__part"], r["__first"], r["__held"]) for r in runs.collect())
        shifts, before = [], 0
        for part, first, held in counts:
            shifts.append((part, before - first + 1))
            before += held
        table = frame.sparkSession.createDataFrame(shifts, "__part int, __shift long")
        joined = placed.join(F.broadcast(table), "__part")
    return joined.withColumn(name, F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")
