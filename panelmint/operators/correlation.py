"""Zero-imputed correlation matrices and principal components from blocked Gram products.

A return matrix has one row per timestamp and one column per chosen symbol, with 0 where a
symbol has no return. It is never pivoted. Returns are packed into blocks of symbols, written once (blocks.py);
a task reads two blocks and emits the sums of their symbol pairs, tile by tile. No pair is shuffled or added up, and no cell
is copied for the blocks it meets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.functions.expressions import bounded_broadcast
from panelmint.functions.kernels import block_products, eigen
from panelmint.operators.blocks import largest_size, meetings, packed_blocks, width_for
from panelmint.operators.subspace import leading_components

SUMS = ("sxy", "sx", "sy", "sxx", "syy")


def chosen_returns(returns: DataFrame, members: DataFrame, settings: Settings, months: int = 1) -> DataFrame:
    """Returns of the chosen symbols, with their matrix position.

    `members` has `month, symbol, ord, size`; it is broadcast only where `max_symbols` bounds it.
    """
    columns = members.select("month", "symbol", "ord", "size")
    bound = None if settings.max_symbols is None else months * settings.max_symbols
    return returns.join(bounded_broadcast(columns, bound), ["month", "symbol"])


def pair_moments(chosen: DataFrame, settings: Settings) -> DataFrame:
    """Sums over the matrix for every pair `i <= j`: `month, i, j, sxy, sx, sy, sxx, syy`.

    The returns are packed and written here; the pairs, a row for each two symbols, are only streamed.
    """
    tile = settings.gram_block
    width = width_for(matrix_rows(chosen), largest_size(chosen), settings, tile)
    place = [F.floor(F.col("ord") / width).cast("int").alias("block"), (F.col("ord") % width).cast("int").alias("slot")]
    cells = chosen.select("month", "timestamp", "ret", *place)
    # Symbols without a return have their columns too.
    sizes = chosen.groupBy("month").agg(F.max("size").alias("size"))
    series = sizes.select("month", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("ord")).select("month", "ord", *place)
    packed = packed_blocks(cells, series, ("ord",))
    return meetings(packed).mapInPandas(
        block_products(tile), "month int, i int, j int, " + ", ".join(f"{s} double" for s in SUMS)
    )


def matrix_rows(returns: DataFrame) -> DataFrame:
    """Rows of the matrix per month: timestamps at which any of the given returns exists."""
    return returns.select("month", "timestamp").distinct().groupBy("month").agg(F.count("*").alias("t"))


def rows_with_any_return(bars: DataFrame, firsts: DataFrame) -> DataFrame:
    """`matrix_rows` over the returns of all symbols, without building those returns.

    Every bar has a return but the first one of its series, so a timestamp counts unless all its
    bars are first bars. `bars` are lookback bars; `firsts` has `month, symbol, first_bar`. Both
    counts are combined on the map side.
    """
    present = bars.groupBy("month", "timestamp").agg(F.count("*").alias("n"))
    opening = firsts.groupBy("month", F.col("first_bar").alias("timestamp")).agg(F.count("*").alias("n_first"))
    return (
        present.join(opening, ["month", "timestamp"], "left")
        .filter(F.col("n") > F.coalesce("n_first", F.lit(0)))
        .groupBy("month")
        .agg(F.count("*").alias("t"))
    )


def correlations(moments: DataFrame, rows: DataFrame) -> DataFrame:
    """Pearson `rho` for `i < j`; null where a symbol does not vary."""
    t = F.col("t")

    def spread(square: str, total: str):
        term = t * F.col(square) - F.col(total) * F.col(total)
        # Rounding leaves a tiny residue for a constant column; it counts as no variance.
        return F.when(term > F.lit(1e-12) * t * F.col(square), term)

    rho = (t * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(spread("sxx", "sx") * spread("syy", "sy"))
    # `rows` has one line per rebalance month.
    return (
        moments.filter(F.col("i") < F.col("j"))
        .join(F.broadcast(rows), "month")
        .select("month", "i", "j", rho.alias("rho"))
    )


def named_edges(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Replace matrix positions by symbols: `month, i, j, symbol_i, symbol_j, rho`.

    The names are broadcast whatever their number: n names have n^2 / 2 pairs, which no join may shuffle.
    """
    for side in ("i", "j"):
        names = members.select("month", F.col("ord").alias(side), F.col("symbol").alias(f"symbol_{side}"))
        edges = edges.join(F.broadcast(names), ["month", side])
    return edges.select("month", "i", "j", "symbol_i", "symbol_j", "rho")


def matrix_summary(edges: DataFrame) -> DataFrame:
    """Pair count and range of the off-diagonal entries."""
    return edges.agg(
        F.count("*").alias("pairs"),
        F.count("rho").alias("defined_pairs"),
        F.min("rho").alias("min_rho"),
        F.max("rho").alias("max_rho"),
        F.avg(F.abs("rho")).alias("mean_abs_rho"),
    )


def principal_components(moments: DataFrame, rows: DataFrame, settings: Settings) -> DataFrame:
    """Loadings of the leading components per month: `month, component, explained_variance, ord, loading`.

    All months are decomposed in one job. A month's moments and a dense
    matrix over its symbols must fit a task: `fitting_components` asks for it up to `dense_symbols`. The sign of a component is fixed by making its largest entry positive.
    """
    # A covariance needs two observations.
    ready = moments.join(F.broadcast(rows.filter(F.col("t") > 1)), "month")
    return ready.groupBy("month").applyInPandas(
        eigen(settings.components),
        "month int, component int, explained_variance double, ord int, loading double",
    )


def fitting_components(chosen: DataFrame, members: DataFrame, moments: Callable[[], DataFrame], settings: Settings) -> DataFrame:
    """Components by one dense matrix per month where every month has at most `dense_symbols` members, by iteration on the returns elsewhere."""
    largest = members.agg(F.max("size")).first()[0] or 0
    if largest <= settings.dense_symbols:
        return principal_components(moments(), matrix_rows(chosen), settings)
    return leading_components(chosen, matrix_rows(chosen), settings)


def explained_variance(loadings: DataFrame, settings: Settings) -> DataFrame:
    """One row per component with the running share and whether it first reaches the target."""
    shares = loadings.groupBy("month", "component").agg(F.first("explained_variance").alias("explained_variance"))
    running = Window.partitionBy("month").orderBy("component")
    reached = F.col("cumulative_variance") >= settings.variance_target
    return shares.withColumn("cumulative_variance", F.sum("explained_variance").over(running)).withColumn(
        "reaches_target",
        reached & ~F.coalesce(F.lag(reached).over(running), F.lit(False)),
    )


def component_scores(chosen: DataFrame, loadings: DataFrame, settings: Settings, months: int = 1) -> DataFrame:
    """Project each matrix row on the components: `month, timestamp, component, score`."""
    bound = None if settings.max_symbols is None else months * settings.max_symbols * settings.components
    axes = loadings.select("month", "ord", "component", "loading")
    return (
        chosen.join(bounded_broadcast(axes, bound), ["month", "ord"])
        .groupBy("month", "timestamp", "component")
        .agg(F.sum(F.col("ret") * F.col("loading")).alias("score"))
    )


def residual_scores(loadings: DataFrame) -> DataFrame:
    """`1 - loading^2` on the first component: high where a symbol is far from the common move."""
    return loadings.filter(F.col("component") == 1).select(
        "month", "ord", (1 - F.col("loading") * F.col("loading")).alias("residual_score")
    )
