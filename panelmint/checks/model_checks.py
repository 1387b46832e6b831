"""Fitted models. SQL can't fit them, but it knows which rows they must cover; beside those rows stand
properties that are computed from the result itself and must hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmint.checks import sql
from panelmint.checks.panel_checks import DIGEST
from panelmint.checks.registry import BENCHMARK, BRANDS, EVENTS, SPAN, brand_year, brands, query, rounded, static
from panelmint.functions.expressions import finite
from panelmint.operators import correlation as corr
from panelmint.operators import models, selection
from panelmint.operators.features import FEATURES
from panelmint.plans.walk_forward import FITTED, WalkForward

EVENT = (sql.EVENT_BARS, sql.RETURNS, sql.EVENT_METRICS)
USABLE = "usable AS (SELECT * FROM metrics WHERE annual_vol > 0 AND sharpe IS NOT NULL)"
WINDOW = (sql.BRAND_BARS, sql.WINDOWS, sql.LOOKBACK, sql.WINDOW_RETURNS, sql.WINDOW_METRICS)
HELD_OUT = (
    sql.EVENT_BARS,
    sql.features("symbol", "bars", "feats"),
    f"held AS (SELECT * FROM feats_full WHERE ('0x' || substr({DIGEST}, 1, 8))::BIGINT >= 3435973836)",
)
BASKET_SIZES = f"""SELECT month, CAST(least({BRANDS.top_n}, count(*)) AS BIGINT) AS members, true AS whole, true AS usable
                   FROM wmetrics WHERE annual_vol > 0 AND sharpe IS NOT NULL GROUP BY month"""


def basket_properties(basket: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per month: members, whether weights are positive and sum to 1, whether all members are candidates."""
    known = candidates.select("month", "symbol").distinct().withColumn("known", F.lit(True))
    met = basket.join(known, ["month", "symbol"], "left")
    whole = (F.abs(F.sum("weight") - 1) < 1e-9) & (F.min("weight") > 0)
    return met.groupBy("month").agg(F.count("*").alias("members"), whole.alias("whole"), F.every(F.coalesce("known", F.lit(False))).alias("usable"))


@query(
    "kmeans_clusters",
    sql.build(
        *EVENT, USABLE,
        select="""SELECT symbol, round(sharpe, 6) AS sharpe, round(annual_ret, 6) AS annual_ret,
                         round(annual_vol, 6) AS annual_vol, true AS in_range, true AS nearest FROM usable""",
    ),
)
def kmeans_clusters(spark, folder):
    """`nearest`: no other cluster's mean is clearly closer; a fit stops when its centres move little."""
    met = models.nearest_centres(static(spark, folder).clusters())
    return rounded(
        met.select(
            "symbol", "sharpe", "annual_ret", "annual_vol",
            F.col("cluster").between(0, EVENTS.clusters - 1).alias("in_range"),
            (F.sqrt("own_distance") <= F.sqrt("least_distance") + 0.05).alias("nearest"),
        ),
        "sharpe", "annual_ret", "annual_vol",
    )


@query(
    "cluster_stats",
    sql.build(
        *EVENT, USABLE,
        select=f"""SELECT least({EVENTS.clusters}, count(*)) AS clusters, count(*) AS symbols, round(avg(sharpe), 6) AS sharpe,
                          round(avg(annual_vol), 6) AS annual_vol, round(avg(annual_ret), 6) AS annual_ret FROM usable""",
    ),
)
def cluster_stats(spark, folder):
    """Profiles of the clusters, weighed by size, are the profile of all symbols."""
    profile = models.cluster_profile(static(spark, folder).clusters())
    means = {c: (F.sum(F.col("size") * F.col(f"mean_{c}")) / F.sum("size")).alias(c) for c in models.RISK_PROFILE}
    total = profile.agg(F.count("*").alias("clusters"), F.sum("size").cast("long").alias("symbols"), *means.values())
    return rounded(total, *models.RISK_PROFILE)


@query(
    "cluster_quality",
    sql.build(*EVENT, USABLE, select=f"SELECT least({EVENTS.clusters}, count(*)) AS clusters, count(*) AS symbols, true AS separated FROM usable"),
)
def cluster_quality(spark, folder):
    clustered = static(spark, folder).clusters()
    score = models.silhouette(clustered)
    return clustered.agg(F.count_distinct("cluster").alias("clusters"), F.count("*").alias("symbols")).withColumn(
        "separated", F.lit(0.0 < score <= 1.0)
    )


@query(
    "cluster_leaders",
    sql.build(
        *EVENT, USABLE,
        select=f"""SELECT least({EVENTS.clusters}, count(*)) AS leaders, round(max(sharpe), 6) AS best,
                          arg_max(symbol, sharpe) AS symbol, true AS unbeaten FROM usable""",
    ),
)
def cluster_leaders(spark, folder):
    clustered = static(spark, folder).clusters()
    leaders = selection.group_leaders(clustered, ("month", "cluster")).select("month", "cluster", "symbol", "sharpe")
    most = clustered.groupBy("month", "cluster").agg(F.max("sharpe").alias("most"))
    met = leaders.join(most, ["month", "cluster"])
    return rounded(
        met.agg(
            F.count("*").alias("leaders"), F.max("sharpe").alias("best"), F.max_by("symbol", "sharpe").alias("symbol"),
            F.every(F.col("sharpe") == F.col("most")).alias("unbeaten"),
        ),
        "best",
    )


@query("cluster_balanced_basket", sql.build(*WINDOW, select=BASKET_SIZES))
def cluster_balanced_basket(spark, folder):
    run = brand_year(spark, folder)
    return basket_properties(run.clusters(), run.metrics())


@query(
    "pca_variance",
    sql.build(
        sql.EVENT_BARS, sql.RETURNS,
        select=f"""SELECT least({EVENTS.components}, count(DISTINCT symbol)) AS components, count(DISTINCT symbol) AS symbols,
                          true AS orthonormal, true AS descending, true AS within FROM rets""",
    ),
)
def pca_variance(spark, folder):
    loadings = static(spark, folder).components().persist()
    axes = loadings.groupBy("ord").agg(F.sort_array(F.collect_list(F.struct("component", "loading"))).alias("axes"))
    # Products of each symbol's own few loadings, summed: the Gram matrix of the components.
    left, right = (F.posexplode("axes.loading").alias(k, v) for k, v in (("a", "x"), ("b", "y")))
    gram = axes.select("axes", left).select("a", "x", right).groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("g"))
    square = gram.agg(F.every(F.abs(F.col("g") - (F.col("a") == F.col("b")).cast("double")) < 1e-6).alias("orthonormal"))
    variance = corr.explained_variance(loadings, EVENTS)
    shares = variance.agg(
        F.count("*").alias("components"),
        F.sort_array(F.collect_list(F.struct((-F.col("component")).alias("c"), "explained_variance"))).alias("v"),
        (F.max("cumulative_variance") <= 1 + 1e-9).alias("within"),
    )
    values = F.col("v.explained_variance")
    descending = (F.sort_array(values) == values).alias("descending")
    sizes = loadings.agg(F.count_distinct("ord").alias("symbols"))
    one = F.lit(1).alias("one")
    joined = shares.select("components", descending, "within", one).join(square.select("*", one), "one").join(sizes.select("*", one), "one")
    return joined.select("components", "symbols", "orthonormal", "descending", "within")


@query(
    "pca_scores",
    sql.build(
        sql.EVENT_BARS, sql.RETURNS,
        select=f"""SELECT timestamp, (SELECT least({EVENTS.components}, count(DISTINCT symbol)) FROM rets) AS components, true AS variance_holds
                   FROM rets GROUP BY timestamp""",
    ),
)
def pca_scores(spark, folder):
    """`variance_holds`: scores of a component vary in proportion to the variance it explains."""
    model = static(spark, folder)
    loadings = model.components().persist()
    scores = corr.component_scores(model.chosen, loadings, EVENTS).persist()
    explained = loadings.groupBy("component").agg(F.first("explained_variance").alias("share"))
    spread = scores.groupBy("component").agg(F.var_samp("score").alias("variance")).join(explained, "component")
    total = spread.agg(F.max_by("variance", "share").alias("v"), F.max("share").alias("s"), F.collect_list(F.struct("variance", "share")).alias("all"))
    holds = F.forall("all", lambda r: F.abs(r["variance"] / F.col("v") - r["share"] / F.col("s")) < 1e-6)
    check = total.select(F.coalesce(holds, F.lit(False)).alias("variance_holds"), F.lit(1).alias("one"))
    counts = scores.groupBy("timestamp").agg(F.count("*").alias("components"), F.lit(1).alias("one"))
    return counts.join(F.broadcast(check), "one").drop("one")  # one row


@query("pca_residual_basket", sql.build(*WINDOW, select=BASKET_SIZES))
def pca_residual_basket(spark, folder):
    run = brand_year(spark, folder)
    return basket_properties(run.pca_residual(), run.candidates)


@query(
    "gbt_forecast",
    sql.build(*HELD_OUT, select="SELECT symbol, timestamp, round(target, 6) AS target, true AS forecast FROM held"),
)
def gbt_forecast(spark, folder):
    _, scored = static(spark, folder).forecast()
    return rounded(scored.select("symbol", "timestamp", "target", finite(F.col("prediction")).alias("forecast")), "target")


@query(
    "gbt_evaluation",
    sql.build(*HELD_OUT, select="SELECT count(*) AS n, true AS sensible FROM held"),
)
def gbt_evaluation(spark, folder):
    """`sensible`: the error is finite and no more than twice that of the mean."""
    _, scored = static(spark, folder).forecast()
    return models.regression_metrics(scored).select("n", (finite(F.col("rmse")) & (F.col("r2") > -3)).alias("sensible"))


@query(
    "gbt_importance",
    "SELECT feature, true AS is_share, true AS whole FROM (VALUES " + ", ".join(f"('{f}')" for f in FEATURES) + ") AS f(feature)",
)
def gbt_importance(spark, folder):
    model, scored = static(spark, folder).forecast()
    table = models.feature_importance(model, scored)
    total = table.agg((F.abs(F.sum("pct_of_total") - 1) < 1e-9).alias("whole"), F.lit(1).alias("one"))
    return table.select("feature", F.col("importance").between(0, 1).alias("is_share"), F.lit(1).alias("one")).join(total, "one").drop("one")


@query(
    "gbt_basket",
    sql.build(
        sql.BRAND_BARS, sql.WINDOWS, sql.LOOKBACK, sql.features("month, symbol", "lookback", "feats"),
        "cuts AS (SELECT month, quantile_disc(timestamp, 0.8) AS split_ts FROM feats_full GROUP BY 1)",
        "later AS (SELECT DISTINCT f.month, symbol FROM feats_full f JOIN cuts c ON c.month = f.month WHERE timestamp > split_ts)",
        select=f"SELECT month, CAST(least({BRANDS.top_n}, count(*)) AS BIGINT) AS members, true AS whole, true AS usable FROM later GROUP BY month",
    ),
)
def gbt_basket(spark, folder):
    run = brand_year(spark, folder)
    return basket_properties(run.forecast(), run.bars())


def _fitted_grid(calendar: str) -> str:
    return sql.build(
        calendar,
        select="SELECT strategy, month, true AS earns, true AS sized FROM windows CROSS JOIN (VALUES "
        + ", ".join(f"('{s}')" for s in FITTED)
        + ") AS s(strategy)",
    )


def _fitted_grid_met(held):
    return held.select(
        "strategy", "month",
        (finite(F.col("month_return")) & (F.col("month_return") > -1)).alias("earns"),
        F.col("num_assets").between(1, BRANDS.top_n).alias("sized"),
    )


@query("walk_forward_ml", _fitted_grid(sql.WINDOWS))
def walk_forward_ml(spark, folder):
    return _fitted_grid_met(brand_year(spark, folder).run(FITTED))


@query("walk_forward_ml_span", _fitted_grid(sql.windows(SPAN)))
def walk_forward_ml_span(spark, folder):
    """The fitted strategies over every month that has a full lookback and a full holding month."""
    return _fitted_grid_met(WalkForward(brands(spark, folder), SPAN, BRANDS, BENCHMARK).run(FITTED))
