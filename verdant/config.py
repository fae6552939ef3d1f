"""Defaults and fixed values.

Everything under "fixed values" must equal the behaviour this engine
re-implements (forecasting and control semantics); changing them changes
results.  Tunables that only affect physical execution live in
``ExecutionConfig``.
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# Fixed values (semantics): canonical columns and their accepted aliases, in
# priority order.  The first alias present in a file wins.
# --------------------------------------------------------------------------
COLUMN_ALIASES: dict[str, list[str]] = {
    "timestamp": ["timestamp", "time", "date", "datetime", "recorded_at", "observation_time"],
    "crop_type": ["crop", "crop_type", "crop_name", "plant", "plant_type", "vegetable", "species", "class"],
    "indoor_temperature_c": [
        "indoor_temperature_c", "indoor_temperature", "air_temperature_c", "air_temperature",
        "temperature_c", "temperature", "temp_c", "temp",
    ],
    "canopy_temperature_c": ["canopy_temperature_c", "canopy_temperature", "leaf_temperature"],
    "ambient_temperature_c": ["ambient_temperature_c", "ambient_temperature", "outside_temperature"],
    "humidity_pct": ["humidity_pct", "humidity", "relative_humidity", "rh"],
    "soil_moisture_pct": ["soil_moisture_pct", "soil_moisture", "soil_water_content"],
    "co2_ppm": ["co2_ppm", "co2", "carbon_dioxide"],
    "light_lux": ["light_lux", "light_intensity", "lux", "sunlight_lux"],
    "days_after_planting": ["days_after_planting", "days", "dap", "day"],
}

# Key inferred from a file name (substring tests, first match wins).
FILENAME_KEY_RULES: list[tuple[tuple[str, ...], str]] = [
    (("tomato",), "tomato"),
    (("chilli", "chili"), "green_chilli"),
    (("brinjal", "eggplant"), "brinjal"),
    (("lady", "okra"), "ladysfinger"),
]
DEFAULT_KEY = "mixed_crop"
UNKNOWN_KEY_SLUG = "unknown_crop"

# Feature order used when selecting forecasting features.
PREFERRED_FEATURES = [
    "canopy_temperature_c", "ambient_temperature_c", "humidity_pct",
    "soil_moisture_pct", "co2_ppm", "light_lux",
]
# What makes a normalised column name a temperature.
TEMPERATURE_NAME = r"temperature|(^|_)temp($|_)"
DEFAULT_TARGET = "indoor_temperature_c"
DEFAULT_TIME = "timestamp"
DEFAULT_KEY_COLUMN = "crop_type"
SYNTHETIC_TIME_ORIGIN = "2025-01-01 00:00:00"

# Pipeline parameters.
SEQUENCE_LENGTH = 6
TEST_RATIO = 0.2
VALIDATION_RATIO = 0.2
MIN_SAMPLES_PER_GROUP = 12
MIN_TRAIN_WINDOWS = 3
CLIP_LOW_Q = 0.01
CLIP_HIGH_Q = 0.99

# Control thresholds (degrees C) and action table, first match wins.
LOW_THRESHOLD = 22.0
HIGH_THRESHOLD = 29.0
SPRAY_THRESHOLD = 31.0
ACTION_SPRAY = ("fan_and_spray_on", 1, 1, "critical_high_temperature")
ACTION_FAN = ("fan_on", 1, 0, "high_temperature")
ACTION_OFF = ("cooling_off", 0, 0, "below_cooling_range")
ACTION_IDLE = ("idle", 0, 0, "optimal_range")

# Ensemble weighting.
ENSEMBLE_METHOD = "balanced_inverse_rmse_weighted_ensemble"
RMSE_FLOOR = 1e-6
PREFERRED_BOOST = 1.08
BLEND_MODEL = 0.80
BLEND_UNIFORM = 0.20
MAX_WEIGHT_FLOOR = 0.42
MAX_WEIGHT_BONUS = 0.12
MAX_WEIGHT_CAP = 0.70
MIN_WEIGHT_MANY = 0.03   # five or more models
MIN_WEIGHT_FEW = 0.02
WEIGHT_TOLERANCE = 1e-8
WEIGHT_ITERATIONS = 10
MAPE_EPSILON = 1e-8
HYBRID_MODEL = "hybrid_coordinated"

# Model settings.
RF_TREES, RF_DEPTH, RF_MIN_LEAF = 260, 14, 2
GB_ROUNDS, GB_RATE, GB_DEPTH, GB_SUBSAMPLE = 280, 0.04, 3, 0.9
XGB_ROUNDS, XGB_RATE, XGB_DEPTH, XGB_SUBSAMPLE, XGB_COLSAMPLE = 320, 0.05, 4, 0.9, 0.9
KNN_NEIGHBOURS = 7
SVR_C = 15.0
HUBER_EPSILON = 1.35
RANDOM_SEED = 42


@dataclass(frozen=True)
class ForecastConfig:
    """Semantic parameters of one forecasting run."""

    key: str = DEFAULT_KEY_COLUMN
    time: str = DEFAULT_TIME
    target: str = DEFAULT_TARGET
    sequence_length: int = SEQUENCE_LENGTH
    test_ratio: float = TEST_RATIO
    validation_ratio: float = VALIDATION_RATIO
    min_samples: int = MIN_SAMPLES_PER_GROUP
    low: float = LOW_THRESHOLD
    high: float = HIGH_THRESHOLD
    spray: float = SPRAY_THRESHOLD
    preferred_model: str = "gru"

    @property
    def effective_min_samples(self) -> int:
        return max(self.min_samples, self.sequence_length + 6)


@dataclass(frozen=True)
class ExecutionConfig:
    """Physical knobs; never change results."""

    # Rows per position block used by lag/interpolation windows.  A block is
    # the unit of work of one window task, so it bounds task memory no matter
    # how large a single series grows.
    block_rows: int = 1 << 17
    # Groups with at most this many values get Spark's exact percentile (its
    # buffer holds the group's distinct values); larger ones the sort path.
    single_task_values: int = 1 << 20


DEFAULT_EXEC = ExecutionConfig()
