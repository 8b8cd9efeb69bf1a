"""Table schemas and the fixed domain values shared by every job.

Numbers in this module are domain constants: an index computed elsewhere with the
same rules can only agree if they are the same here.
"""

from __future__ import annotations

from pyspark.sql import types as T

POLLUTANTS = ["pm2_5", "pm10", "no2", "o3", "co", "so2", "nh3"]
WEATHER = ["temperature", "humidity", "pressure", "wind_speed", "wind_deg",
           "clouds", "precipitation"]
SENSORS = POLLUTANTS + WEATHER

SENTINEL = -9999.0

# --- fixed values: averaging windows of the index (hours, least observations) ---
AVERAGING = {
    "pm2_5": (24, 18),
    "pm10": (24, 18),
    "co": (8, 6),
    "o3": (8, 6),
}

# --- fixed values: how far missing hours are filled from either side ---
FILL_LIMIT_HOURS = 3

# --- fixed values: forecast blocks, split, clip range, alert level ---
HORIZONS = {1: (1, 24), 2: (25, 48), 3: (49, 72)}
MAX_LEAD = 72
SPLIT_RATIO = 0.8
PREDICTION_RANGE = (0.0, 700.0)
ALERT_LEVEL = 150
MIN_TRAINING_ROWS = 5000
STALE_HOURS = 48
HISTORY_DAYS = 30
CONTEXT_ROWS = 200
RANDOM_SEED = 42
TOP_DRIVERS = 12
EXPLAIN_ROWS = 2000
BACKGROUND_ROWS = 300
EXPLAIN_LEADS = {1: 12, 2: 36, 3: 60}

# --- fixed values: window lengths of the feature table ---
LAGS = [1, 3, 6, 12, 24, 48, 72, 168]
ROLLING = [("1d", 24, 6), ("3d", 72, 18), ("7d", 168, 42)]
TRENDS = [6, 24, 72]
POLLUTANT_WINDOWS = ["pm2_5", "pm10", "o3", "co"]
WEATHER_MEANS = ["temperature", "humidity", "wind_speed", "pressure"]
LEAD_INTERACTIONS = ["aqi", "aqi_trend_24h", "aqi_trend_72h", "aqi_roll_std_1d",
                     "aqi_vs_7d"]

CALENDAR_FEATURES = ["hour", "day", "month", "day_of_week", "is_weekend",
                     "hour_sin", "hour_cos", "month_sin", "month_cos",
                     "season_winter", "season_summer", "season_monsoon",
                     "season_post_monsoon"]
LAG_FEATURES = (
    [f"aqi_lag_{h}h" for h in LAGS]
    + [f"aqi_roll_{stat}_{name}" for name, _, _ in ROLLING for stat in ("mean", "std")]
    + ["aqi_roll_max_1d", "aqi_roll_min_1d", "aqi_range_1d"]
    + [f"aqi_trend_{h}h" for h in TRENDS]
    + ["aqi_vs_7d"]
    + [f"{p}_{kind}_24h" for p in POLLUTANT_WINDOWS for kind in ("lag", "roll")]
)
WEATHER_FEATURES = (
    ["wind_u", "wind_v", "ventilation", "calm_flag", "pressure_trend_24h",
     "temp_range_24h", "precip_24h", "precip_72h"]
    + [f"{c}_roll_24h" for c in WEATHER_MEANS]
)

#: The 69 numeric model inputs, in the order models are trained with.
FEATURES = SENSORS + ["aqi"] + CALENDAR_FEATURES + LAG_FEATURES + WEATHER_FEATURES
#: The seven inputs that depend on how far ahead a prediction looks.
LEAD_FEATURES = (["hours_ahead", "sqrt_hours_ahead"]
                 + [f"{c}_x_hours" for c in LEAD_INTERACTIONS])
MODEL_INPUTS = FEATURES + LEAD_FEATURES

INTEGER_FEATURES = {"hour", "day", "month", "day_of_week", "is_weekend",
                    "season_winter", "season_summer", "season_monsoon",
                    "season_post_monsoon", "calm_flag"}


def _doubles(names):
    return [T.StructField(n, T.DoubleType()) for n in names]


_KEY = [T.StructField("station_id", T.LongType(), False),
        T.StructField("ts", T.TimestampType(), False)]

POLLUTANT_SCHEMA = T.StructType(
    _KEY + [T.StructField("city", T.StringType())] + _doubles(POLLUTANTS))

WEATHER_SCHEMA = T.StructType(
    _KEY + _doubles(WEATHER) + _doubles(["boundary_layer_height"]))

MERGED_SCHEMA = T.StructType(
    _KEY + [T.StructField("city", T.StringType())] + _doubles(SENSORS))

FEATURE_SCHEMA = T.StructType(
    _KEY
    + [T.StructField("city", T.StringType()),
       T.StructField("dominant_pollutant", T.StringType())]
    + [T.StructField(n, T.LongType() if n in INTEGER_FEATURES else T.DoubleType())
       for n in FEATURES])

#: Pollutant payload: readings in a list, seconds since the epoch.
POLLUTANT_PAYLOAD = T.StructType([
    T.StructField("list", T.ArrayType(T.StructType([
        T.StructField("dt", T.LongType()),
        T.StructField("components", T.StructType(_doubles(POLLUTANTS))),
    ]))),
])

# --- fixed values: variable names of the weather payload and our column names ---
WEATHER_VARIABLES = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "pressure_msl": "pressure",
    "wind_speed_10m": "wind_speed",
    "wind_direction_10m": "wind_deg",
    "cloud_cover": "clouds",
    "precipitation": "precipitation",
    "boundary_layer_height": "boundary_layer_height",
}

#: Weather payload: one array per variable, all as long as ``time``.
WEATHER_PAYLOAD = T.StructType([
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in WEATHER_VARIABLES])),
])

#: What drives the forecast: one document per station, one entry per explained lead time.
EXPLANATION_SCHEMA = T.StructType([
    T.StructField("station_id", T.LongType()),
    T.StructField("explained_from", T.TimestampType()),
    T.StructField("current_aqi", T.LongType()),
    T.StructField("horizons", T.ArrayType(T.StructType([
        T.StructField("day", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("hours_ahead", T.IntegerType()),
        *_doubles(["base", "prediction", "gap"]),
        *[T.StructField(name, T.ArrayType(T.StructType([
            T.StructField("rank", T.IntegerType()), T.StructField("feature", T.StringType()),
            T.StructField("label", T.StringType()), T.StructField(amount, T.DoubleType())])))
          for name, amount in (("global_importance", "mean_abs"),
                               ("current_explanation", "contribution"))],
    ]))),
])

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("station_id", T.LongType()),
    T.StructField("predicted_from", T.TimestampType()),
    T.StructField("current", T.StructType([
        T.StructField("ts", T.TimestampType()),
        T.StructField("aqi", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("dominant_pollutant", T.StringType()),
        T.StructField("trend_6h", T.DoubleType()),
        T.StructField("direction", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.LongType()),
        T.StructField("air", T.StringType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("wind_deg", T.LongType()),
        T.StructField("pollutants", T.MapType(T.StringType(), T.DoubleType())),
    ])),
    T.StructField("forecast", T.ArrayType(T.StructType([
        T.StructField("hours_ahead", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("aqi", T.LongType()),
        T.StructField("category", T.StringType()),
    ]))),
    T.StructField("daily", T.ArrayType(T.StructType([
        T.StructField("day", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("mean_aqi", T.LongType()),
        T.StructField("min_aqi", T.LongType()),
        T.StructField("max_aqi", T.LongType()),
        T.StructField("category", T.StringType()),
    ]))),
    T.StructField("history", T.ArrayType(T.StructType([
        T.StructField("ts", T.TimestampType()),
        T.StructField("aqi", T.LongType()),
    ]))),
    T.StructField("pollutant_history",
                  T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
    T.StructField("models", T.ArrayType(T.StructType([
        T.StructField("model", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("r2", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
    ]))),
])
