"""Log returns, over a whole history or restarted inside each lookback window."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmint.config import Schedule, Settings
from panelmint.functions.expressions import bounded_broadcast, log_ratio, month_start, with_chunk
from panelmint.operators.ranking import distributed_rank


def chunked_bars(panel: DataFrame, settings: Settings) -> DataFrame:
    """Bars with the chunk of the time grid they fall into."""
    keyed = panel.filter(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull())
    return with_chunk(keyed, settings.chunk_micros).select("symbol", "chunk", "timestamp", "close")


def bar_returns(panel: DataFrame, settings: Settings) -> DataFrame:
    """Every bar with its return: `symbol, timestamp, previous_at, ret`.

    `ret` is `ln(close / close of the previous observed bar)`, `previous_at` the time of that
    bar; both are null for the first bar of a symbol.

    A symbol may own a large share of all rows, so its history is cut into chunks of the time
    grid. Inside a chunk the previous bar is a plain lag; the first bar of a chunk takes the
    last bar of the symbol's previous non-empty chunk from a table with one row per chunk.
    Both sides read the same exchange, so the panel is scanned and shuffled once.
    """
    bars = chunked_bars(panel, settings).repartition("symbol", "chunk")
    by_chunk = Window.partitionBy("symbol").orderBy("chunk")
    carried = (
        bars.groupBy("symbol", "chunk")
        .agg(F.max("timestamp").alias("last_at"), F.max_by("close", "timestamp").alias("last_close"))
        .select(
            "symbol",
            "chunk",
            F.lag("last_at").over(by_chunk).alias("carried_at"),
            F.lag("last_close").over(by_chunk).alias("carried_close"),
        )
    )
    inside = Window.partitionBy("symbol", "chunk").orderBy("timestamp")
    return (
        bars.withColumns({"before_at": F.lag("timestamp").over(inside), "before_close": F.lag("close").over(inside)})
        # Every chunk has its row in `carried`; "left" keeps Spark from adding null filters to
        # one side only, which would stop it from reusing the exchange.
        .join(carried, ["symbol", "chunk"], "left")
        .select(
            "symbol",
            "timestamp",
            F.coalesce("before_at", "carried_at").alias("previous_at"),
            log_ratio(F.col("close"), F.coalesce("before_close", "carried_close")).alias("ret"),
        )
    )


def log_returns(panel: DataFrame, settings: Settings) -> DataFrame:
    """`symbol, timestamp, ret` over whole histories, without the bars that have no return."""
    return bar_returns(panel, settings).filter(F.col("ret").isNotNull()).select("symbol", "timestamp", "ret")


def in_lookbacks(bars: DataFrame, schedule: Schedule) -> DataFrame:
    """Every bar once per rebalance month that looks back on it: adds `month, lb_start`.

    The months follow from the date by arithmetic, so no join with the schedule is needed.
    """
    first = F.lit(schedule.hold_starts[0].date())
    last = F.lit(schedule.hold_starts[-1].date())
    next_month = F.add_months(month_start(F.col("timestamp")), 1)
    candidates = F.sequence(
        next_month, F.add_months(next_month, schedule.windows_per_bar - 1), F.expr("interval 1 month")
    )
    hold = F.col("hold_start")
    month = ((F.year(hold) - F.year(first)) * 12 + F.month(hold) - F.month(first) + 1).cast("int")
    return (
        bars.select("*", F.explode(candidates).alias("hold_start"))
        .withColumn("lb_start", F.date_sub("hold_start", schedule.lookback_days).cast("timestamp_ntz"))
        .filter((F.col("timestamp") >= F.col("lb_start")) & hold.between(first, last))
        .withColumn("month", month)
        .drop("hold_start")
    )


def lookback_panel(panel: DataFrame, schedule: Schedule) -> DataFrame:
    """The part of the panel that any lookback needs; the time range reaches the scan."""
    return time_range(panel, schedule.begin, schedule.hold_starts[-1])


def lookback_bars(panel: DataFrame, schedule: Schedule) -> DataFrame:
    """Bars of each month's lookback: `month, symbol, timestamp, close`."""
    bars = lookback_panel(panel, schedule).select("symbol", "timestamp", "close")
    return in_lookbacks(bars, schedule).select("month", "symbol", "timestamp", "close")


def window_bar_returns(panel: DataFrame, schedule: Schedule, settings: Settings) -> DataFrame:
    """Bars of each lookback with their return inside it: `month, symbol, timestamp, ret`.

    The lag restarts in each window: a bar whose previous bar lies before the window has no
    return there. So returns are taken once for all months, and bars are copied to their months
    afterwards, without another shuffle.
    """
    bars = bar_returns(lookback_panel(panel, schedule), settings)
    inside = F.col("previous_at") >= F.col("lb_start")
    return in_lookbacks(bars, schedule).select("month", "symbol", "timestamp", F.when(inside, F.col("ret")).alias("ret"))


def windowed_returns(panel: DataFrame, schedule: Schedule, settings: Settings) -> DataFrame:
    """The same without the bars that have no return."""
    return window_bar_returns(panel, schedule, settings).filter(F.col("ret").isNotNull())


def time_range(panel: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Bars in `[start, end)`. Prunes year/month partitions where the panel carries them."""
    ts = F.col("timestamp")
    bars = panel.filter((ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz")))
    if {"year", "month"} <= set(panel.columns):
        number = F.col("year") * 12 + F.col("month")
        bars = bars.filter(
            number.between(start.year * 12 + start.month, end.year * 12 + end.month)
        )
    return bars


def only_symbols(panel: DataFrame, symbols: DataFrame, at_most: int | None = None) -> DataFrame:
    """Bars of the given symbols. `at_most` bounds the number of symbols where it is known."""
    keys = symbols.select("symbol")
    return panel.join(keys if at_most is None else bounded_broadcast(keys, at_most), "symbol", "left_semi")


def bars_at(panel: DataFrame, instants: list[datetime]) -> DataFrame:
    """Bars stamped exactly with one of the given instants; never the nearest one."""
    stamps = [F.lit(t).cast("timestamp_ntz") for t in instants]
    covering = time_range(panel, min(instants), max(instants) + timedelta(microseconds=1))
    return covering.filter(F.col("timestamp").isin(stamps))


def wide_returns(returns: DataFrame, columns: list[str]) -> DataFrame:
    """One row per timestamp, one column per listed symbol, 0 where a symbol has no return."""
    return (
        returns.groupBy("timestamp")
        .pivot("symbol", columns)
        .agg(F.first("ret"))
        .fillna(0.0, subset=columns)
    )


def symbol_numbers(returns: DataFrame) -> DataFrame:
    """(symbol, number): the symbols that have a return, numbered from 0 in their order."""
    symbols = returns.filter(F.col("symbol").isNotNull() & F.col("ret").isNotNull()).select("symbol").distinct()
    return distributed_rank(symbols, [F.col("symbol").asc()], name="number").withColumn("number", F.col("number") - 1)


def sparse_returns(returns: DataFrame, numbers: DataFrame, block: int = 4096) -> DataFrame:
    """The matrix of `wide_returns` for any number of symbols: (timestamp, block, indices, values).

    A row holds the returns of one timestamp for the symbols numbered `block` x `block size` and on; indices ascend and count from the start of the
    block, so no row is wider than `block`. What is not listed is 0: symbols without a return, blocks without a row. A timestamp has a return of a
    symbol at most once, as `log_returns` gives it. Returns that are null, and those of symbols without a number, are left out.
    """
    known = returns.filter(F.col("ret").isNotNull()).join(numbers, "symbol")
    cell = F.struct((F.col("number") % block).cast("int").alias("at"), "ret")
    grouped = known.groupBy("timestamp", F.floor(F.col("number") / block).cast("int").alias("block"))
    rows = grouped.agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return rows.select("timestamp", "block", F.col("cells.at").alias("indices"), F.col("cells.ret").alias("values"))
