"""Models fitted once over the whole history of a panel."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.operators import correlation as corr
from panelmint.operators.features import FEATURES, forecast_frame
from panelmint.operators.metrics import asset_metrics
from panelmint.operators.models import cluster_assets, fit_ready, fit_static_forecast, settled, vectors
from panelmint.operators.returns import log_returns, only_symbols
from panelmint.operators.selection import as_members, top_sharpe, universe_cap
from panelmint.operators.splits import hash_split, row_cap
from panelmint.operators.strong_pairs import StagedPairs, staged_pairs, strong_pairs
from panelmint.operators.tournament import tournament
from panelmint.operators.weights import inverse_vol_weights
from panelmint.session import written_once


@dataclass(frozen=True)
class StaticModels:
    """The whole history is treated as one window, `month = 0`.

    The bars are written once to the checkpoint folder (far fewer rows than what they are made from) and every model
    reads them there. What several models share is kept: the universe, one row per symbol for
    the metrics and the returns of the universe; one row per pair of it only where components ask for a dense matrix.
    """

    panel: DataFrame
    settings: Settings

    @cached_property
    def bars(self) -> DataFrame:
        return written_once(self.panel.select("symbol", "timestamp", "close"))

    @cached_property
    def universe(self) -> DataFrame:
        return as_members(universe_cap(self.bars, self.settings)).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def metrics(self) -> DataFrame:
        returns = log_returns(self.bars, self.settings)
        return asset_metrics(returns, self.settings).withColumn("month", F.lit(0)).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def universe_panel(self) -> DataFrame:
        if self.settings.max_symbols is None:
            return self.bars
        return only_symbols(self.bars, self.universe, at_most=self.settings.max_symbols)

    @cached_property
    def chosen(self) -> DataFrame:
        """Returns of the universe with their matrix positions."""
        returns = log_returns(self.universe_panel, self.settings).withColumn("month", F.lit(0))
        chosen = corr.chosen_returns(returns, self.universe, self.settings)
        return chosen.persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def moments(self) -> DataFrame:
        return corr.pair_moments(self.chosen, self.settings).persist(StorageLevel.MEMORY_AND_DISK)

    def edges(self) -> DataFrame:
        # Streamed: a row for each pair is more than disks hold.
        return corr.correlations(corr.pair_moments(self.chosen, self.settings), corr.matrix_rows(self.chosen))

    def named_edges(self) -> DataFrame:
        return corr.named_edges(self.edges(), self.universe)

    def strong_edges(self) -> DataFrame:
        """The pairs above the threshold, without the matrix."""
        return strong_pairs(self.chosen, corr.matrix_rows(self.chosen), self.settings)

    def staged_edges(self, members: DataFrame) -> StagedPairs:
        """The same for a tournament, block by block."""
        return staged_pairs(self.chosen, corr.matrix_rows(self.chosen), members, self.settings)

    def survivors(self) -> DataFrame:
        """Universe in matrix order (most bars first), metrics where known, losers left out."""
        members = self.universe.join(self.metrics, ["month", "symbol"], "left")
        return tournament(self.staged_edges(members), members, self.settings)

    def smart_basket(self) -> DataFrame:
        """The universe, correlation tournament, best Sharpe ratios, inverse-volatility weights."""
        return self._basket(self.survivors())

    def simple_basket(self) -> DataFrame:
        """The same without the tournament."""
        return self._basket(self.metrics)

    def _basket(self, source: DataFrame) -> DataFrame:
        top = top_sharpe(source, self.settings.top_n)
        return inverse_vol_weights(top).select("symbol", "weight", "sharpe", "annual_ret", "annual_vol")

    def clusters(self) -> DataFrame:
        return cluster_assets(self.metrics, self.settings)

    def components(self) -> DataFrame:
        return corr.fitting_components(self.chosen, self.universe, lambda: self.moments, self.settings)

    def scores(self) -> DataFrame:
        """Every timestamp projected on the components."""
        return corr.component_scores(self.chosen, self.components(), self.settings)

    def forecast(self) -> tuple[GBTRegressionModel, DataFrame]:
        """Boosted trees on the universe: the model and all held-out rows, scored."""
        # Split, counted and ranked below; kept so that the features are built once.
        frame = forecast_frame(self.universe_panel, self.settings).persist(StorageLevel.MEMORY_AND_DISK)
        split = hash_split(frame, self.settings.train_share)
        train = row_cap(split.filter("is_train"), self.settings.row_cap)
        ready = fit_ready(vectors(train, FEATURES), self.settings, ["symbol", "timestamp"])
        model = fit_static_forecast(ready, self.settings)
        scored = model.transform(vectors(split.filter(~F.col("is_train")), FEATURES))
        return model, settled(scored, ready, frame)

    def release(self) -> None:
        """Let go of the kept tables."""
        for name in ("moments", "chosen", "metrics", "universe"):
            if name in self.__dict__:
                self.__dict__.pop(name).unpersist()
