"""Column roles and decision parameters shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Which column plays which part in a record table."""

    key: str = "person_id"
    label: str = "high_income"
    label_source: str = "wage_income"
    weight: str = "person_weight"
    categorical: tuple[str, ...] = (
        "education",
        "occupation",
        "class_of_worker",
        "marital_status",
    )
    numeric: tuple[str, ...] = ("age", "hours_per_week")
    sensitive: tuple[str, ...] = ("race", "sex", "nativity")
    feature_order: tuple[str, ...] = (
        "age",
        "education",
        "occupation",
        "hours_per_week",
        "class_of_worker",
        "marital_status",
    )


@dataclass(frozen=True)
class Limits:
    """Decision thresholds; the defaults are the published ones."""

    label_cut: float = 75_000.0
    min_age: int = 18
    test_share: float = 0.20
    seed: int = 42
    min_auc: float = 0.82
    score_cut: float = 0.5
    fairness_cut: float = 0.20
    review_cut: float = 0.15
    min_group: int = 30
    gap_growth: float = 0.05
    ppr_shift: float = 0.10
    drift_alert: float = 0.20
    dataset_drift_share: float = 0.5
    distance_cut: float = 0.1
    p_value_cut: float = 0.05
    match_tolerance: float = 0.05
    balance_low: float = 0.3
    balance_high: float = 0.7
    folds: int = 5
    c_grid: tuple[float, ...] = (100.0, 10.0, 1.0, 0.1, 0.01, 0.001)


ROLES = Roles()
LIMITS = Limits()
