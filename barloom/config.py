"""Parameter objects shared by the backtest and graph jobs."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class BacktestConfig:
    """Windows of an expanding backtest, all counted in common trading dates."""

    lookback: int = 20
    test_days: int = 50
    initial_train: int = 504
    val_days: int = 50
    ridge_alphas: tuple[float, ...] = (0.01, 0.1, 1.0, 10.0, 100.0)
    blend_alphas: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0)
    direction_eps: float = 0.0


@dataclass(frozen=True)
class GraphConfig:
    """Thresholds of the symbol graph."""

    recent_days: int = 504
    pearson_threshold: float = 0.70
    pearson_topk: int = 5
    min_support: float = 0.05
    min_confidence: float = 0.10
    lift_threshold: float = 1.50
    assoc_topk: int = 3
    assoc_weight: float = 0.50
    final_topk: int = 4


# The variant of the graph that the paper notebook uses.
PAPER_GRAPH = replace(GraphConfig(), pearson_threshold=0.85, lift_threshold=1.7, final_topk=5)
