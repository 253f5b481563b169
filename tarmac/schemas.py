"""Explicit schemas, ordered level lists and vocabularies.

Level lists are passed explicitly to ``pivot`` and encoders, so plans and
output columns never depend on the data (no extra distinct-values job).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay as they are for results to line up)
# ---------------------------------------------------------------------------
# Weekday labels, index 0 = Monday.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# Day parts: [5,12) morning, [12,17) afternoon, [17,22) evening, else night.
DAY_PARTS = ["morning", "afternoon", "evening", "night"]
# Signed-delay bands, right-closed: (-inf,0], (0,15], (15,30], (30,60], (60,inf).
DELAY_BANDS = ["early/on-time", "1-15", "15-30", "30-60", "60+"]
DELAY_BAND_EDGES = [0, 15, 30, 60]
# Histogram bands, right-closed edges -200,-1,0,5,15,30,60,200,1000; outside -> null.
HIST_EDGES = [-200, -1, 0, 5, 15, 30, 60, 200, 1000]
HIST_LABELS = ["< 0", "0", "1-5", "6-15", "16-30", "31-60", "61-200", "> 200"]
# Origin airport of every departure (degrees) and the earth radius (km).
ORIGIN_LAT = 50.0777
ORIGIN_LON = 19.7848
EARTH_RADIUS_KM = 6371.0
# Group-size floors and list lengths used by the views.
TOP_N = 15
MIN_FLIGHTS = 30
# Significance level and effect-size cut-offs.
ALPHA = 0.05
EPS2_CUTS = [0.01, 0.06, 0.14]          # negligible / small / moderate / large
RBC_CUTS = [0.1, 0.3, 0.5]              # negligible / small / medium / large
V_CUTS = [0.1, 0.3, 0.5]                # negligible / weak / moderate / strong
RHO_CUTS = [0.1, 0.3, 0.5, 0.7]         # negligible / weak / moderate / strong / very strong
# Bootstrap settings of the median CI.
N_BOOTSTRAP = 2000
SEED = 42

# Carrier vocabulary of the driver fixture: 'C00'..'C24' (rule, not a list).
N_CARRIERS = 25
CARRIER_VOCAB = [f"C{i:02d}" for i in range(N_CARRIERS)]

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
RAW_DEPARTURES = T.StructType([
    T.StructField("row_id", T.LongType(), False),
    T.StructField("flight_date", T.DateType(), False),
    T.StructField("flight_no", T.StringType(), False),
    T.StructField("carrier", T.StringType(), True),
    T.StructField("route", T.StringType(), True),
    T.StructField("planned_ts", T.TimestampNTZType(), True),
    T.StructField("actual_ts", T.TimestampNTZType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
])

LOCATIONS = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lon", T.DoubleType(), True),
    T.StructField("elev", T.DoubleType(), True),
])

FOLD_SCORE = T.StructType([
    T.StructField("fold", T.IntegerType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("balanced_accuracy", T.DoubleType()),
])

MODEL_SCORES = T.StructType([
    T.StructField("folds", T.ArrayType(FOLD_SCORE)),
    T.StructField("mean_f1", T.DoubleType()),
    T.StructField("mean_balanced_accuracy", T.DoubleType()),
    T.StructField("std_f1", T.DoubleType()),
    T.StructField("std_balanced_accuracy", T.DoubleType()),
])

RUN_LOG = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("dataset", T.StructType([
        T.StructField("encoding", T.StringType()),
        T.StructField("resampling", T.StringType()),
        T.StructField("threshold", T.IntegerType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("feature_count", T.IntegerType()),
        T.StructField("run_index", T.IntegerType()),
        T.StructField("cv_random_state", T.IntegerType()),
        T.StructField("oot_train_rows", T.LongType()),
        T.StructField("oot_test_rows", T.LongType()),
    ])),
    T.StructField("experiment", T.StringType()),
    T.StructField("validation_scheme", T.StringType()),
    T.StructField("search_kind", T.StringType()),
    T.StructField("strategy", T.StringType()),
    T.StructField("best_params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("search_results", T.ArrayType(T.StructType([
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("mean_test_f1", T.DoubleType()),
        T.StructField("std_test_f1", T.DoubleType()),
        T.StructField("rank_test_f1", T.IntegerType()),
    ]))),
    T.StructField("models", T.MapType(T.StringType(), MODEL_SCORES)),
    T.StructField("winner", T.StructType([
        T.StructField("model", T.StringType()),
        T.StructField("mean_f1", T.DoubleType()),
        T.StructField("mean_balanced_accuracy", T.DoubleType()),
    ])),
])
