"""Business constants of the analysis, gathered in one immutable object."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # The business calendar, thresholds and names the results depend on.
    ref_date: dt.date = dt.date(2024, 6, 30)
    window_start: dt.date = dt.date(2022, 1, 1)
    window_end: dt.date = dt.date(2024, 6, 30)
    churn_days: int = 60
    recent_days: int = 90
    max_period: int = 18
    horizon_days: int = 365
    half_life_days: float = 90.0
    haircut: float = 0.25
    risk_bins: tuple[float, float] = (0.30, 0.60)
    categories: tuple[str, ...] = ("mayo", "sauces", "dips")

    # Model sizes. The defaults are the documented ones; tests pass smaller values.
    n_clusters: int = 5
    kmeans_restarts: int = 20
    kmeans_iterations: int = 500
    forest_trees: int = 300
    churn_rounds: int = 200
    ltv_rounds: int = 300
    cv_folds: int = 5
    parallel_fits: int = 5
    test_fraction: float = 0.20
    seed: int = 42
