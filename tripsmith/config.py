"""Fixed values that must equal the reference behaviour for equal results.

Fixed values (kept together, in natural order):
  feature list (contract order), target, rush hours, cleaning limits,
  New York bounding box, gate thresholds, spike percentile / weight,
  override threshold, dominance threshold, bin counts, verdict cuts.
"""

# -- fixed values: feature contract -------------------------------------------
FEATURES = [
    "hour",
    "day_of_week",
    "month",
    "is_weekend",
    "is_rush_hour",
    "distance_km",
    "passenger_count",
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
    "vendor_id",
]
TARGET = "trip_duration"
TIME_COL = "pickup_datetime"
KEY_COL = "id"
PROCESSED_COLUMNS = FEATURES + [TARGET, TIME_COL]
PIT_FEATURES = ["trip_count_last_1h", "avg_duration_same_hour_last7days"]

RAW_COLUMNS = [
    "id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "store_and_fwd_flag", "trip_duration",
]

# -- fixed values: cleaning rules ---------------------------------------------
RUSH_HOURS = [7, 8, 9, 17, 18, 19]
WEEKEND_FIRST_DAY = 5            # 0 = Monday
EARTH_RADIUS_KM = 6371.0
MIN_DURATION_S = 60              # strict: duration > 60
MAX_DURATION_S = 7200            # strict: duration < 7200
MIN_DISTANCE_KM = 0.1            # strict: distance > 0.1
MIN_PASSENGERS = 0               # strict: passengers > 0
LAT_BOUNDS = (40.4, 41.0)        # inclusive
LON_BOUNDS = (-74.5, -73.5)      # inclusive

# -- fixed values: quality gates ----------------------------------------------
MAX_NULL_RATE = 0.02
MAX_ZERO_COORD_RATE = 0.01
MIN_ROW_COUNT = 100000
MAX_BAD_GPS_RATE = 0.05
NULL_GATE_COLUMNS = ["pickup_latitude", "pickup_longitude", "dropoff_latitude",
                     "dropoff_longitude", "trip_duration"]
ZERO_GATE_COLUMNS = ["pickup_latitude", "pickup_longitude"]
VERIFY_COLUMNS = ["hour", "day_of_week", "month", "is_weekend", "is_rush_hour",
                  "distance_km", "passenger_count", "pickup_latitude", "pickup_longitude",
                  "dropoff_latitude", "dropoff_longitude", "vendor_id", "trip_duration"]
VERIFY_NOT_NULL = ["distance_km", "trip_duration", "hour"]
VERIFY_MIN_ROWS = 100000

# -- fixed values: splits -------------------------------------------------------
TRAIN_FRAC = 0.75
GAP_FRAC = 0.05

# -- fixed values: evaluation / calibration ---------------------------------------
SPIKE_PERCENTILE = 0.95
SPIKE_WEIGHT = 5.0
PRED_CLIP_MIN = 60.0
OVERRIDE_THRESHOLD = 0.40
SPIKE_BINS = 20
RELIABILITY_BINS = 10
DOMINANCE_THRESHOLD = 0.70
REGISTRY_SHARE_LIMIT = 0.05
ADDITIVITY_TOLERANCE = 1.0

# -- fixed values: verdict bands (cuts ascending, labels one longer, whether a cut is
#    part of the label before it) ------------------------------------------------------
OVERFIT_BANDS = ([15.0, 30.0], ["healthy", "mild overfit", "severe overfit"], True)
SLICE_RATIO_BANDS = ([2.0, 3.0, 4.0], ["excellent", "good", "moderate", "poor"], False)
STABILITY_BANDS = ([0.05, 0.15], ["STABLE", "MODERATE", "VOLATILE"], False)
CALIBRATION_BANDS = ([0.05, 0.10], ["good", "moderate", "poor"], False)
IMPROVEMENT_VS_BASELINE_BANDS = ([0.0, 10.0, 25.0], ["worse", "weak", "moderate", "strong"], False)
IMPROVEMENT_VS_LINEAR_BANDS = ([5.0, 20.0], ["barely beats linear", "moderate non-linearity",
                                             "strong non-linearity"], False)
TEST_GAP_BANDS = ([0.0, 50.0], ["matches or beats validation", "slight degradation",
                                "significant degradation"], True)
BIAS_LIMIT_S = 10.0
CALIBRATION_DIRECTION_LIMIT = 0.05
OVERRIDE_PRECISION_LIMIT = 0.3
