"""Run parameters. Plain dataclasses; every operator takes the values it needs as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeatureSpec:
    windows: tuple[int, ...] = (10, 20, 50)
    stats: tuple[str, ...] = ("mean", "std")
    lags: tuple[int, ...] = (1, 5)
    deltas: tuple[int, ...] = (1,)
    include_slopes: bool = False  # accepted for compatibility; no feature depends on it

    def first_complete_cycle(self, window_l: int) -> int:
        """Smallest cycle at which every feature of a gap-free engine is defined."""
        return max(
            window_l,
            max(self.windows, default=1),
            max(self.lags, default=0) + 1,
            max(self.deltas, default=0) + 1,
        )

    def history(self) -> int:
        """Rows before the current one that some feature reads."""
        return max(
            max(self.windows, default=1) - 1,
            max(self.lags, default=0),
            max(self.deltas, default=0),
        )


@dataclass(frozen=True)
class SplitSpec:
    train: float = 0.7
    val: float = 0.15
    test: float = 0.15
    seed: int = 42


@dataclass(frozen=True)
class PolicySpec:
    target_recall: float = 0.85
    min_precision: float = 0.30
    bucket_cutoffs: tuple[float, float] = (0.20, 0.50)


@dataclass(frozen=True)
class ForestSpec:
    contamination: float = 0.02
    n_trees: int = 100
    max_samples: int = 256
    seed: int = 42


@dataclass(frozen=True)
class BacktestSpec:
    n_folds: int = 3
    test_engines_per_fold: int = 10
    train_min_engines: int = 40
    val_ratio: float = 0.2
    candidates: tuple[str, ...] = ("logreg", "gbt")
    calibration_bins: int = 10
    calibration_strategy: str = "quantile"
    early_alarm_slack: int = 10


@dataclass(frozen=True)
class ModelSpec:
    logreg_max_iter: int = 1000
    gbt_trees: int = 100
    gbt_step: float = 0.1
    gbt_depth: int = 5
    mlp_hidden: int = 32
    mlp_epochs: int = 20  # at most
    mlp_steps: int = 5  # optimiser steps of an epoch
    mlp_patience: int = 5  # epochs without improvement before training stops
    seed: int = 42


@dataclass(frozen=True)
class Profile:
    """Everything one run needs."""

    horizon_n: int = 30
    window_l: int = 50
    features: FeatureSpec = field(default_factory=FeatureSpec)
    split: SplitSpec = field(default_factory=SplitSpec)
    policy: PolicySpec = field(default_factory=PolicySpec)
    forest: ForestSpec = field(default_factory=ForestSpec)
    backtest: BacktestSpec = field(default_factory=BacktestSpec)
    models: ModelSpec = field(default_factory=ModelSpec)
    featureset_version: str = "v1"


SHORT = Profile(
    horizon_n=8,
    window_l=10,
    features=FeatureSpec(windows=(3, 5, 10)),
)
