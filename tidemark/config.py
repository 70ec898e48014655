"""Fixed values the results depend on.

Fixed values (must equal the modelled workflow's settings for equal results):

* feature columns, categorical:  product, payment_method, gender, state,
  customer_continent, franchise_name, franchise_city, franchise_size,
  franchise_country
* feature columns, numeric:      unit_price, hour, day_of_week, month, day_of_month
* label:                         quantity
* alarm thresholds:              RMSE > 5.0, R2 < 0.5 (strict comparisons)
* holdout share and seed:        20 %, seed 42
* stress-run seed:               99; unit price factor uniform in [0.1, 5.0);
  hour uniform int in [0, 24), day_of_week in [1, 8), month in [1, 13)
* sweep (trees / depth / min split, seed 42): 50/5/10, 100/10/5, 150/15/3, 200/20/2
* retrain configuration:         150/12/3, seed 42
* watched metric names:          batch_rmse, batch_mae, batch_r2, rmse, mae, r2
* stress-run tag:                drift_simulation = 'true' (missing tag means 'false')
* alias of the serving version:  champion
* watcher period:                6 hours
"""

from __future__ import annotations

from dataclasses import dataclass, field

CATEGORICAL_COLS = [
    "product", "payment_method", "gender", "state", "customer_continent",
    "franchise_name", "franchise_city", "franchise_size", "franchise_country",
]
NUMERIC_COLS = ["unit_price", "hour", "day_of_week", "month", "day_of_month"]
LABEL_COL = "quantity"
KEY_COL = "transaction_id"

RMSE_THRESHOLD = 5.0
R2_THRESHOLD = 0.5

SPLIT_SEED = 42
TEST_FRACTION = 0.2
DRIFT_SEED = 99

SWEEP_CONFIGS = [
    {"n_estimators": 50, "max_depth": 5, "min_samples_split": 10, "random_state": 42},
    {"n_estimators": 100, "max_depth": 10, "min_samples_split": 5, "random_state": 42},
    {"n_estimators": 150, "max_depth": 15, "min_samples_split": 3, "random_state": 42},
    {"n_estimators": 200, "max_depth": 20, "min_samples_split": 2, "random_state": 42},
]
RETRAIN_CONFIG = {"n_estimators": 150, "max_depth": 12, "min_samples_split": 3, "random_state": 42}

WATCHED_METRICS = ["batch_rmse", "batch_mae", "batch_r2", "rmse", "mae", "r2"]
DRIFT_TAG = "drift_simulation"
CHAMPION_ALIAS = "champion"
WATCH_PERIOD = "6 hours"

# Columns the stress run shifts; day_of_month and categoricals stay as they are.
DRIFTED_COLS = ["unit_price", "hour", "day_of_week", "month"]

# Decimal places every double is rounded to in oracle-compared results.
ROUND_DIGITS = 6


@dataclass(frozen=True)
class WatchConfig:
    """Environment x model variant, as chosen by the scheduled watcher."""

    environment: str = "dev"
    model_variant: str = "decorators"
    rmse_threshold: float = RMSE_THRESHOLD
    r2_threshold: float = R2_THRESHOLD
    exclude_tags: dict = field(default_factory=dict)

    @property
    def schema_name(self) -> str:
        return "dev_mlops" if self.environment == "dev" else "prod_mlops"

    @property
    def model_name(self) -> str:
        return f"{self.schema_name}.{self.model_variant}_model"
