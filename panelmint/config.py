"""Parameters of the engine: one frozen object for the models, one for the calendar."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date, datetime, timedelta


@dataclass(frozen=True)
class Settings:
    """Model parameters. The defaults are the fixed values of the published study."""

    bar: timedelta = timedelta(hours=4)
    periods_per_year: float = 365 * 6
    min_obs: int = 50
    theta: float = 0.85
    top_n: int = 20
    max_symbols: int | None = None  # only on request: the symbols with most bars, or the best ratios
    clusters: int = 5
    components: int = 10
    variance_target: float = 0.90
    seed: int = 42
    train_share: float = 0.8
    prediction_floor: float = 0.001
    initial_capital: float = 10_000.0

    # Boosted trees: the static model is lighter than the one fitted per rebalance month. The cap
    # bounds training rows only; every held-out row is scored.
    row_cap: int = 400_000
    static_trees: int = 12
    static_depth: int = 4
    static_subsample: float = 0.7
    monthly_trees: int = 20
    monthly_depth: int = 5
    step_size: float = 0.1

    # Physical layout. A chunk is a stretch of the bar grid, so one symbol can put at most
    # `chunk_bars` rows into it, however long its history is.
    chunk_bars: int = 512
    gram_block: int = 256
    block_cells: int = 2_000_000  # most matrix positions of the blocks a task packs; two such blocks meet in a task
    dense_symbols: int = 2048  # up to here a month's covariance is decomposed as one matrix; beyond, by iteration
    fit_partitions: int | None = None  # None: as many as `rows_per_fit_task` asks for
    rows_per_fit_task: int = 100_000
    parallel_fits: int = 8
    months_one_by_one: int = 48  # longer calendars have their boosted models fitted together

    @property
    def chunk_micros(self) -> int:
        return int(self.bar.total_seconds() * 1_000_000) * self.chunk_bars


@dataclass(frozen=True)
class Schedule:
    """Monthly rebalancing: hold calendar month `m`, look back `lookback_days` before it."""

    first: date
    months: int = 12
    lookback_days: int = 90
    bar: timedelta = timedelta(hours=4)

    @property
    def hold_starts(self) -> list[datetime]:
        return [self._month_start(k) for k in range(self.months)]

    @property
    def begin(self) -> datetime:
        """First instant any lookback needs."""
        return self._month_start(0) - timedelta(days=self.lookback_days)

    @property
    def end(self) -> datetime:
        """First instant after the last holding month."""
        return self._month_start(self.months)

    @property
    def windows_per_bar(self) -> int:
        """Most rebalance months that can look back on one bar (a month has 28 days or more)."""
        return math.ceil(self.lookback_days / 28) + 1

    def _month_start(self, offset: int) -> datetime:
        years, month = divmod(self.first.month - 1 + offset, 12)
        return datetime(self.first.year + years, month + 1, 1)
