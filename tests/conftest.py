from datetime import datetime, timedelta

import numpy as np
import pytest

from panelmint.session import local_session

START = datetime(2025, 1, 1)
BAR = timedelta(hours=4)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_panel(spark):
    def build(rows):
        """Rows of (symbol, timestamp, close)."""
        return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double")

    return build


@pytest.fixture(scope="session")
def ragged(make_panel):
    """Random panel with gaps: symbols start and stop at different bars, some bars are missing."""
    rng = np.random.default_rng(7)
    rows = []
    for k in range(12):
        first, last = sorted(rng.integers(0, 400, 2))
        price = 100.0
        for bar in range(first, last + 60):
            price *= float(np.exp(rng.normal(0, 0.02)))
            if rng.random() < 0.7:
                rows.append((f"S{k:02d}", START + bar * BAR, price))
    return make_panel(rows), rows
