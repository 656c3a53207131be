"""Tunable parameters of the jobs, with the published defaults."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    id_column: str = "customer_id"
    target_column: str = "churn"

    # training
    test_size: float = 0.15
    val_size: float = 0.15
    seed: int = 42
    baseline_model: str = "logistic_regression"
    candidate_model: str = "random_forest"
    max_iterations: int = 1000
    trees: int = 300
    tree_depth: int = 8
    min_leaf_rows: int = 5
    #: Part of the model's definition: another number may give another forest.
    training_partition_rows: int = 100_000

    # promotion guardrail
    min_roc_auc: float = 0.80
    max_regression: float = 0.01

    # monitoring
    drift_features: tuple[str, ...] = (
        "tenure_months",
        "monthly_charges",
        "total_charges",
        "senior_citizen",
    )
    non_negative_columns: tuple[str, ...] = (
        "tenure_months",
        "monthly_charges",
        "total_charges",
    )
    drift_threshold: float = 2.0
    max_missing_fraction: float = 0.05
    recent_rows: int = 400

    # retraining triggers
    min_new_days: int = 7
    auc_drop: float = 0.03
    drift_trigger: float = 2.0

    @classmethod
    def read(cls, path: str | None) -> Settings:
        """Settings from a JSON file of some of the fields; others keep their defaults."""
        if not path:
            return cls()
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        unknown = sorted(set(given) - {field.name for field in fields(cls)})
        if unknown:
            raise ValueError(f"unknown settings: {unknown}")
        return cls(**{name: tuple(v) if isinstance(v, list) else v for name, v in given.items()})
