"""Rating parameters, scenarios and overrides."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields, replace


# The default rating parameters.
@dataclass(frozen=True)
class RatingConfig:
    window_days: int = 365
    max_games: int = 30
    inactive_days: int = 180
    goal_diff_cap: int = 6
    recent_k: int = 10
    recent_share: float = 0.70
    tail_start: int = 26
    tail_end: int = 30
    tail_start_weight: float = 0.8
    tail_end_weight: float = 0.4
    performance_k: float = 0.15
    performance_decay: float = 0.08
    performance_threshold: float = 1.0
    adaptive_alpha: float = 0.5
    adaptive_beta: float = 0.6
    outlier_z: float = 2.5
    shrink_tau: float = 8.0
    provisional_alpha: float = 1.5
    min_games: int = 6
    sos_stretch: float = 1.5
    off_weight: float = 0.20
    def_weight: float = 0.20
    sos_weight: float = 0.60
    ridge_ga: float = 0.25
    unranked_base: float = 0.35
    # Options. The defaults give the published results.
    fill_short_history: bool = False
    apply_sos_stretch: bool = False
    stepwise_floor: bool = True


BASELINE = RatingConfig()

# What each tuning scenario changes against the baseline.
SCENARIO_OVERRIDES: dict[str, dict[str, float]] = {
    "baseline": {},
    "sweep_window_days": {"window_days": 180},
    "sweep_max_games": {"max_games": 20},
    "sweep_recent_emphasis": {"recent_k": 15, "recent_share": 0.80},
    "sweep_performance_sensitivity": {"performance_k": 0.25, "performance_decay": 0.12},
    "sweep_adaptive_k": {"adaptive_alpha": 0.7, "adaptive_beta": 0.8},
    "sweep_outlier_protection": {"outlier_z": 2.0},
    "sweep_bayesian_shrinkage": {"shrink_tau": 12.0},
    "sweep_provisional_threshold": {"min_games": 8, "provisional_alpha": 2.0},
    "sweep_sos_stretch": {"sos_stretch": 2.0},
    "sweep_scoring_weights": {"off_weight": 0.30, "def_weight": 0.30, "sos_weight": 0.40},
    "sweep_conservative": {
        "window_days": 180, "max_games": 20, "recent_k": 8, "recent_share": 0.60,
        "performance_k": 0.10, "adaptive_alpha": 0.3, "adaptive_beta": 0.4,
        "outlier_z": 2.0, "shrink_tau": 12.0, "min_games": 8, "provisional_alpha": 2.0,
        "sos_stretch": 1.2, "off_weight": 0.25, "def_weight": 0.25, "sos_weight": 0.50,
    },
    "sweep_aggressive": {
        "window_days": 540, "max_games": 40, "recent_k": 15, "recent_share": 0.80,
        "performance_k": 0.25, "adaptive_alpha": 0.7, "adaptive_beta": 0.8,
        "outlier_z": 3.0, "shrink_tau": 4.0, "min_games": 4, "provisional_alpha": 1.0,
        "sos_stretch": 2.0, "off_weight": 0.15, "def_weight": 0.15, "sos_weight": 0.70,
    },
}


def override(base: RatingConfig, changes: dict[str, object]) -> RatingConfig:
    """``base`` with ``changes`` applied; unknown names are an error."""
    known = {f.name for f in fields(RatingConfig)}
    unknown = sorted(set(changes) - known)
    if unknown:
        raise ValueError(f"unknown parameters: {unknown}")
    return replace(base, **changes)


def scenarios(base: RatingConfig = BASELINE) -> dict[str, RatingConfig]:
    """Every tuning scenario as a full configuration."""
    return {name: override(base, changes) for name, changes in SCENARIO_OVERRIDES.items()}


def as_dict(config: RatingConfig) -> dict[str, object]:
    return asdict(config)
