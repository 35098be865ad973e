"""Dataset, gate and candidate specifications.

The default values below are the reference's configuration and must stay
equal to it for equal results.
"""
from __future__ import annotations

import copy
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class ListFeature:
    column: str
    length: int
    prefix: str


@dataclass(frozen=True)
class Interaction:
    a: str
    b: str
    prefix: str


@dataclass
class DatasetSpec:
    target_column: str
    canonical_columns: list[str] = field(default_factory=list)
    column_rename: dict[str, str] = field(default_factory=dict)
    drop_columns: list[str] = field(default_factory=list)
    scalar_numeric_features: list[str] = field(default_factory=list)
    list_features: list[ListFeature] = field(default_factory=list)
    interactions: list[Interaction] = field(default_factory=list)
    split_column: str = "split"
    split_train_value: str = "train"
    split_eval_value: str = "eval"

    def replace(self, **changes) -> "DatasetSpec":
        spec = copy.deepcopy(self)
        for key, value in changes.items():
            setattr(spec, key, value)
        return spec


@dataclass
class GateSpec:
    hard_minimums: dict[str, float] = field(default_factory=dict)
    beat_metric: str | None = "roc_auc"
    beat_min_delta: float = 0.0
    exempt: list[str] = field(default_factory=list)


@dataclass
class CandidateSpec:
    name: str
    kind: str
    params: dict[str, Any] = field(default_factory=dict)
    notes: str = ""


# ---------------------------------------------------------------------------
# The reference configuration (dataset contract, quality gates,
# candidate list). Kept in the reference's order.
# ---------------------------------------------------------------------------
CANONICAL_COLUMNS = [
    "user_id", "gmap_id", "category_encoded", "avg_rating", "location_popularity",
    "destination_vibe_tag", "user_total_visits", "user_personal_preferences", "will_visit",
]
COLUMN_RENAME = {
    "location_id": "gmap_id",
    "location_avg_rating": "avg_rating",
    "location_vibe_tags": "destination_vibe_tag",
    "location_category_encoded": "category_encoded",
}
LAKE_META_COLUMNS = ["split", "pipeline_run_date", "snapshot_id"]


def default_dataset_spec() -> DatasetSpec:
    return DatasetSpec(
        target_column="will_visit",
        canonical_columns=list(CANONICAL_COLUMNS),
        column_rename=dict(COLUMN_RENAME),
        drop_columns=["user_id", "gmap_id"],
        scalar_numeric_features=["avg_rating", "location_popularity", "user_total_visits"],
        list_features=[
            ListFeature("category_encoded", 21, "cat_enc"),
            ListFeature("destination_vibe_tag", 20, "vibe"),
            ListFeature("user_personal_preferences", 20, "user_pref"),
        ],
        interactions=[Interaction("user_pref", "vibe", "pref_x_vibe")],
        split_column="split",
        split_train_value="train",
        split_eval_value="eval",
    )


def default_gate_spec() -> GateSpec:
    return GateSpec(
        hard_minimums={"roc_auc": 0.55, "recall": 0.30},
        beat_metric="roc_auc",
        beat_min_delta=0.02,
        exempt=["baseline"],
    )


def default_candidates() -> list[CandidateSpec]:
    return [
        CandidateSpec("baseline", "dummy", {"strategy": "most_frequent"},
                      "Naive lower-bound. Always predicts majority class."),
        CandidateSpec("hist_gradient_boosting", "hist_gradient_boosting",
                      {"learning_rate": 0.1, "max_iter": 100, "max_depth": 6,
                       "min_samples_leaf": 20, "random_state": 42},
                      "Histogram gradient boosting."),
        CandidateSpec("xgboost_v1", "xgboost",
                      {"learning_rate": 0.3, "max_depth": 6, "n_estimators": 100,
                       "scale_pos_weight": 1.0, "random_state": 42, "n_jobs": -1},
                      "Boosting with default params."),
        CandidateSpec("xgboost_v2", "xgboost",
                      {"learning_rate": 0.1, "max_depth": 6, "n_estimators": 100,
                       "subsample": 0.85, "colsample_bytree": 0.8, "min_child_weight": 2,
                       "reg_lambda": 1.5, "random_state": 42, "n_jobs": -1},
                      "Tuned boosting: lower learning rate, row and column subsampling."),
    ]


# Threshold gates of the registry gate job (name, metric, threshold, operator),
# the baseline F1 margin and the production regression margin.
REGISTRY_GATES = [
    ("f1_minimum", "f1", 0.60, ">="),
    ("auc_minimum", "roc_auc", 0.70, ">="),
    ("precision_minimum", "precision", 0.55, ">="),
    ("recall_minimum", "recall", 0.50, ">="),
]
BASELINE_F1_MARGIN = 0.05
PRODUCTION_REGRESSION_MARGIN = 0.02

# Leaderboard columns: parameter keys, quality metric keys (4 decimals) and
# cost metric keys (2 decimals).
LEADERBOARD_PARAM_KEYS = [
    "candidate.kind",
    "candidate.params.learning_rate",
    "candidate.params.max_depth",
    "candidate.params.n_estimators",
    "candidate.params.scale_pos_weight",
    "candidate.params.strategy",
]
LEADERBOARD_QUALITY_KEYS = ["accuracy", "f1", "roc_auc", "average_precision"]
LEADERBOARD_COST_KEYS = ["train_seconds", "rows_per_second"]

# Hyper-parameter search defaults: rounds, rung spacing, halving factor and trials at a time.
SEARCH_MAX_ROUNDS = 100
SEARCH_GRACE_PERIOD = 25
SEARCH_REDUCTION_FACTOR = 2
SEARCH_AT_ONCE = 2


def find_candidate(candidates: list[CandidateSpec], name: str) -> CandidateSpec:
    by_name = {c.name: c for c in reversed(candidates)}  # the first of a name wins
    if name not in by_name:
        raise ValueError(f"no candidate is called {name!r}; known: {sorted(by_name)}")
    return by_name[name]


def candidates_frame(spark, candidates: list[CandidateSpec]):
    """Candidates as a long ``(candidate, key, value)`` table with dotted keys
    (the flattened parameter view)."""
    from .operators.schema import flatten_dict
    from dataclasses import asdict
    rows = []
    for cand in candidates:
        for key, value in flatten_dict(asdict(cand)).items():
            rows.append((cand.name, key, None if value is None else str(value)))
    return spark.createDataFrame(rows, "candidate string, key string, value string")
