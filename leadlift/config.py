"""Run settings. Every date in a run follows from ``as_of``; nothing reads the clock."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# Codes and thresholds that the input systems and consumers use.
OPEN_STATUSES = ("E0001", "E0007")
WON_STATUSES = ("E0003", "E0004")
CONSULTING_ITEM_TYPES = ("CONS", "SUPP", "EDU", "ZCOS", "SERV")
EXCLUDED_PARTNER_KINDS = ("A", "L", "U", "X", "Y")
EXCLUDED_SEGMENTS = ("01", "")
EXCLUDED_ROLE = "BUP004"
ACTIVE_STATUSES = ("E0004", "E0006", "E0007", "E0008")
DAMPED_INTERNAL_SEGMENTS = ("", "01")
DAMPED_MARKET_SEGMENTS = ("N/R", "N/A")
DAMPING_DIVISOR = 100
LOGICAL_PREFIXES = ("LPR", "LSV")
SCENARIO = "Solution Area Level 3"
INTEREST_BANDS = (
    (10, "1 Top High"),
    (20, "2 High"),
    (40, "3 Medium High"),
    (60, "4 Medium Low"),
    (100, "5 Low"),
)
LEVELS = ("LEVEL1", "LEVEL2", "LEVEL3", "LEVEL4", "LEVEL5", "LEVEL6")
CANDIDATE_LEVELS = {
    "generic": ("LEVEL6", "LEVEL7"),
    "consulting": ("LEVEL4", "LEVEL5", "LEVEL6", "LEVEL7"),
}

# Keep rate of negatives by (activity group, target-class group).
SAMPLING_FRACTIONS = {
    ("active", "C/O/blank"): 0.15,
    ("active", "P"): 0.05,
    ("active", "other"): 0.25,
    ("inactive", "C/O/blank"): 0.075,
    ("inactive", "P"): 0.025,
    ("inactive", "other"): 0.125,
}

# The forest search space.
FOREST_GRID = {
    "numTrees": (100, 200, 300),
    "maxDepth": (8, 12, 16),
    "minInstancesPerNode": (1, 2, 4),
    "weighting": ("balanced", "none"),
}


@dataclass(frozen=True)
class RunConfig:
    as_of: date
    model_type: str = "generic"  # or "consulting"
    hierarchy_year: str = "2024"
    periods: int = 8
    year_window: str = "reference"  # or "rolling12"
    spine: str = "accounts_x_periods"  # or "reference"
    first_open_statuses: tuple[str, ...] | None = None  # None: the open statuses
    decile_source: str = "score"  # or "percentile"
    correlation_mode: str = "keep_first"  # or "drop_both"
    balance: str = "smote_tomek"  # or "weights", "none"
    mode: str = "first"  # or "refresh"
    reference_apply: bool = False  # True: scoring's quarter block has no date range
    open_statuses: tuple[str, ...] = OPEN_STATUSES
    won_statuses: tuple[str, ...] = WON_STATUSES
    consulting_item_types: tuple[str, ...] = CONSULTING_ITEM_TYPES
    feature_level: str = "LEVEL6"
    candidate_levels: tuple[str, ...] | None = None  # None: by model type
    line_months: int = 40
    history_months: int = 42
    candidate_months: int = 30
    min_accounts: int = 50
    refresh_products: int | None = None  # how many of the stalest a refresh takes; it must be given
    train_fraction: float = 0.7
    # Rows that ``fit_sample`` draws for a trial by hand. A training run fits on all its rows.
    fit_rows: int = 200_000
    correlation_threshold: float = 0.60
    search_iterations: int | None = None  # None: every setting of the grid
    folds: int = 5
    grid: dict = field(default_factory=lambda: dict(FOREST_GRID))
    parallelism: int = 4
    nodes_per_pass: int = 2_000_000  # tree nodes of the models that one pass applies
    seed: int = 42

    @property
    def wanted_levels(self) -> tuple[str, ...]:
        return self.candidate_levels or CANDIDATE_LEVELS[self.model_type]

    @property
    def first_open(self) -> tuple[str, ...]:
        return self.first_open_statuses or self.open_statuses
