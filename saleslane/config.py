"""Parameters of every stage, with the default values of the workload."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class AggregationConfig:
    instock_threshold: float = 60.0
    interpolation_limit: int | None = 7
    promo_threshold: float = 0.2


@dataclass(frozen=True)
class FeatureConfig:
    lags: tuple[int, ...] = (7, 14, 28)
    rolling_windows: tuple[int, ...] = (7, 28)
    exclude_current: bool = False
    promo_lag: int = 7
    no_promo_days: int = 999
    holiday_pre: int = 7
    holiday_post: int = 5
    temp_norm_window: int = 14
    cold_quantile: float = 0.1
    hot_quantile: float = 0.9
    wet_quantile: float = 0.9


@dataclass(frozen=True)
class SplitConfig:
    """``anchor='start'`` takes the first ``train`` dates, then ``val``, then ``test``.

    ``anchor='end'`` takes the last ``test`` dates, the ``val`` dates before them and, with
    ``train=None``, every earlier date for training.
    """

    train: int | None = 1000
    val: int = 30
    test: int = 30
    anchor: str = "start"


@dataclass(frozen=True)
class EtsConfig:
    period: int = 7
    trend: str | None = "add"
    seasonal: str | None = "mul"
    damped: bool = True
    # Given together they are used as they are; otherwise a grid is searched.
    alpha: float | None = None
    beta: float | None = None
    gamma: float | None = None
    fixed_phi: float = 0.98
    # The ends are the bounds of the parameters, so no winner is cut off by the grid.
    grid_alpha: tuple[float, ...] = (0.0, 0.03, 0.1, 0.25, 0.5, 1.0)
    grid_beta: tuple[float, ...] = (0.0, 0.02, 0.1, 0.4, 1.0)
    grid_gamma: tuple[float, ...] = (0.0, 0.03, 0.1, 0.3, 1.0)
    grid_phi: tuple[float, ...] = (0.8, 0.9, 0.95, 0.995)
    refine: bool = True
    refinements: int = 3

    @property
    def is_fixed(self) -> bool:
        return None not in (self.alpha, self.beta, self.gamma)


@dataclass(frozen=True)
class BoostConfig:
    rounds: int = 300
    learning_rate: float = 0.05
    max_depth: int = 5
    num_leaves: int = 31
    min_rows_per_leaf: int = 20
    min_gain: float = 0.0
    lambda_l1: float = 0.1
    lambda_l2: float = 0.1
    feature_fraction: float = 0.8
    row_fraction: float = 0.8
    # Trees that share a sample of rows.
    bagging_freq: int = 5
    max_bins: int = 64
    # Rounds without a gain on validation rows before boosting stops; None grows all rounds.
    patience: int | None = 30
    seed: int = 42


@dataclass(frozen=True)
class TuningConfig:
    enabled: bool = True
    trials: int = 50
    folds: int = 3
    min_train: int = 500
    val: int = 30
    anchor: str = "start"
    seed: int = 42


@dataclass(frozen=True)
class TargetConfig:
    mape: float = 20.0
    mase: float = 1.0


@dataclass(frozen=True)
class PipelineConfig:
    keys: tuple[str, ...] = ("category",)
    horizon: int | None = None  # None: as long as the test split
    aggregation: AggregationConfig = field(default_factory=AggregationConfig)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    split: SplitConfig = field(default_factory=SplitConfig)
    ets: EtsConfig = field(default_factory=EtsConfig)
    boost: BoostConfig = field(default_factory=BoostConfig)
    tuning: TuningConfig = field(default_factory=TuningConfig)
    targets: TargetConfig = field(default_factory=TargetConfig)
