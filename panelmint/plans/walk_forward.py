"""Monthly walk-forward evaluation: baskets from the lookback, returns from the month after it.

All months run in one plan. Only the MLlib fits run month by month; boosted models of a long calendar are fitted together.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmint.config import Schedule, Settings
from panelmint.operators import correlation as corr
from panelmint.operators.features import windowed_forecast_frame
from panelmint.operators.holding import holding_returns
from panelmint.operators.metrics import annualised, series_stats
from panelmint.operators.models import cluster_assets, monthly_predictions
from panelmint.operators.returns import lookback_bars, only_symbols, time_range, window_bar_returns, windowed_returns
from panelmint.operators.selection import as_members, candidate_cap, round_robin, top_residual, top_sharpe
from panelmint.operators.splits import chronological_split
from panelmint.operators.strong_pairs import StagedPairs, staged_pairs, strong_pairs
from panelmint.operators.tournament import tournament
from panelmint.operators.weights import (
    benchmark_weights,
    fallback_weights,
    forecast_weights,
    inverse_vol_weights,
    with_fallback,
)
from panelmint.session import written_once

DECLARATIVE = ("benchmark", "top_sharpe", "tournament")
FITTED = ("clusters", "pca_residual", "forecast")


@dataclass(frozen=True)
class WalkForward:
    """One panel with its calendar. Baskets are `month, symbol, weight`.

    The bars of the calendar's time range are written once to the checkpoint folder, and every
    strategy reads them there. One row per month and symbol, the candidates, their returns and
    the pair moments of dense components are kept for all strategies.
    """

    panel: DataFrame
    schedule: Schedule
    settings: Settings
    benchmark_symbol: str

    @property
    def members_at_most(self) -> int | None:
        cap = self.settings.max_symbols
        return None if cap is None else self.schedule.months * cap

    @cached_property
    def prices(self) -> DataFrame:
        """Bars of the lookbacks and of the holding months."""
        covered = time_range(self.panel, self.schedule.begin, self.schedule.end)
        return written_once(covered.select("symbol", "timestamp", "close"))

    def bars(self) -> DataFrame:
        return lookback_bars(self.prices, self.schedule)

    @cached_property
    def series(self) -> DataFrame:
        """One row per month and symbol: return statistics and the first bar of the window."""
        bars = window_bar_returns(self.prices, self.schedule, self.settings)
        stats = series_stats(bars, ("month",), F.min("timestamp").alias("first_bar"))
        return stats.persist(StorageLevel.MEMORY_AND_DISK)

    def metrics(self) -> DataFrame:
        return annualised(self.series, self.settings)

    @cached_property
    def candidates(self) -> DataFrame:
        """Candidates in matrix order: best Sharpe ratio first."""
        return as_members(candidate_cap(self.metrics(), self.settings)).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def chosen(self) -> DataFrame:
        """Returns of the candidates with their matrix positions."""
        panel = self.prices
        if self.settings.max_symbols is not None:
            panel = only_symbols(panel, self.candidates.select("symbol").distinct(), at_most=self.members_at_most)
        returns = windowed_returns(panel, self.schedule, self.settings)
        chosen = corr.chosen_returns(returns, self.candidates, self.settings, self.schedule.months)
        return chosen.persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def moments(self) -> DataFrame:
        return corr.pair_moments(self.chosen, self.settings).persist(StorageLevel.MEMORY_AND_DISK)

    def edges(self) -> DataFrame:
        """Correlations of the candidates; matrix rows are all timestamps with any return."""
        moments = corr.pair_moments(self.chosen, self.settings)
        return corr.correlations(moments, corr.rows_with_any_return(self.bars(), self.series))

    def strong_edges(self) -> DataFrame:
        """The pairs above the threshold, without the matrix."""
        return strong_pairs(self.chosen, corr.rows_with_any_return(self.bars(), self.series), self.settings)

    def staged_edges(self) -> StagedPairs:
        """The same for the tournament, block by block."""
        rows = corr.rows_with_any_return(self.bars(), self.series)
        return staged_pairs(self.chosen, rows, self.candidates, self.settings)

    def survivors(self) -> DataFrame:
        return tournament(self.staged_edges(), self.candidates, self.settings, self.schedule.months)

    def benchmark(self) -> DataFrame:
        return benchmark_weights(self.panel.sparkSession, self.benchmark_symbol, self.schedule)

    def top_sharpe(self) -> DataFrame:
        return fallback_weights(self.metrics(), self.settings)

    def tournament(self) -> DataFrame:
        # A month with fewer than two candidates has no pairs: all of them survive, which is the
        # plain basket.
        return inverse_vol_weights(top_sharpe(self.survivors(), self.settings.top_n))

    def clusters(self) -> DataFrame:
        grouped = cluster_assets(self.metrics(), self.settings)
        return inverse_vol_weights(round_robin(grouped, self.settings.top_n))

    def loadings(self) -> DataFrame:
        """First component of each month; matrix rows are the candidates' own timestamps."""
        first_only = replace(self.settings, components=1)
        return corr.fitting_components(self.chosen, self.candidates, lambda: self.moments, first_only)

    def pca_residual(self) -> DataFrame:
        scored = self.candidates.join(corr.residual_scores(self.loadings()), ["month", "ord"])
        basket = inverse_vol_weights(top_residual(scored, self.settings))
        return with_fallback(basket, self.top_sharpe())

    def predictions(self) -> DataFrame:
        frame = windowed_forecast_frame(self.prices, self.schedule)
        return monthly_predictions(chronological_split(frame, self.settings.train_share), self.settings, self.schedule.months)

    def forecast(self) -> DataFrame:
        return forecast_weights(self.predictions(), self.settings)

    def baskets(self, strategies: tuple[str, ...]) -> DataFrame:
        """Weights of several strategies, stacked: `strategy, month, symbol, weight`."""
        stacked = None
        for name in strategies:
            basket = getattr(self, name)().select(F.lit(name).alias("strategy"), "month", "symbol", "weight")
            stacked = basket if stacked is None else stacked.unionByName(basket)
        return stacked

    def run(self, strategies: tuple[str, ...] = DECLARATIVE + FITTED) -> DataFrame:
        """`strategy, month, month_return, num_assets` for every strategy and month."""
        rows = len(strategies) * self.schedule.months * self.settings.top_n
        return holding_returns(
            self.baskets(strategies), self.prices, self.schedule, list(strategies), basket_rows=rows
        )

    def release(self) -> None:
        """Let go of the kept tables."""
        for name in ("moments", "chosen", "candidates", "series"):
            if name in self.__dict__:
                self.__dict__.pop(name).unpersist()
