"""Merged readings to the feature table: the one definition batch and stream share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.functions import features as feats
from hazegrid.functions import index as aqi
from hazegrid.operators import windows as win
from hazegrid.operators.chunks import CHUNK_HOURS, KEY, drop_halo
from hazegrid.operators.grid import filled_frames
from hazegrid.schemas import AVERAGING, FEATURES, INTEGER_FEATURES, SENSORS

WARM_UP = ["aqi", "aqi_lag_168h", "aqi_roll_mean_7d"]

#: Sensors behind features that do not bear their names.
_BEHIND = {"wind_u": ["wind_speed", "wind_deg"], "wind_v": ["wind_speed", "wind_deg"],
           "ventilation": ["wind_speed", "humidity"], "calm_flag": ["wind_speed"],
           "temp_range_24h": ["temperature"], "precip_24h": ["precipitation"],
           "precip_72h": ["precipitation"]}


def sensors_behind(columns) -> list[str]:
    """The sensors that columns of the feature table are made of; the index is in every one."""
    wanted = {*AVERAGING}
    for c in columns:
        wanted |= {*_BEHIND.get(c, [s for s in SENSORS if c == s or c.startswith(f"{s}_")])}
    return [s for s in SENSORS if s in wanted]


def hourly_index(merged: DataFrame, *, size: int = CHUNK_HOURS, scales=aqi.SCALES,
                 sensors=SENSORS, **fill) -> DataFrame:
    """Every hour with filled sensors, the index and its dominant pollutant."""
    back = max(n for n, _ in AVERAGING.values()) - 1
    frames = filled_frames(merged, sensors, back, size=size, **fill)
    frames = drop_halo(win.with_index(win.with_averages(frames, weather=False), scales), size)
    return frames.select(KEY, feats.hour_start("hour").alias("ts"), "city", *sensors, "aqi",
                         "dominant_pollutant")


def feature_frames(merged: DataFrame, *, size: int = CHUNK_HOURS, scales=aqi.SCALES,
                   extended: bool = False, **fill) -> DataFrame:
    """All windowed columns per hour, warm-up hours included."""
    frames = filled_frames(merged, SENSORS, win.BACK_HOURS, size=size, **fill)
    # sensors that were left out as nobody reads what is made of them
    frames = frames.withColumns({c: F.lit(None).cast("double") for c in SENSORS if c not in merged.columns})
    frames = win.with_index(win.with_averages(frames), scales)
    frames = win.with_aqi_windows(frames, extended)
    return drop_halo(frames, size).withColumn("ts", feats.hour_start("hour"))


def features(merged: DataFrame, *, size: int = CHUNK_HOURS, scales=aqi.SCALES,
             **fill) -> DataFrame:
    """The 69 features of every hour, before the warm-up is dropped."""
    frames = feature_frames(merged, size=size, scales=scales, **fill)
    columns = {**feats.calendar(), **feats.weather()}
    kinds = {n: "long" if n in INTEGER_FEATURES else "double" for n in FEATURES}
    return frames.withColumns(columns).selectExpr(
        KEY, "ts", "city", "dominant_pollutant",
        *[f"cast({n} as {kind}) as {n}" for n, kind in kinds.items()])


def build_features(merged: DataFrame, **options) -> DataFrame:
    """The feature table: warm-up hours and hours without an index are dropped."""
    return features(merged, **options).dropna(subset=WARM_UP)


def build_columns(merged: DataFrame, columns, **options) -> DataFrame:
    """All rows of the feature table with some of its columns; no others are made.

    ``merged`` may lack the sensors that are not ``sensors_behind`` the columns.
    """
    held = [s for s in sensors_behind(columns) if s in merged.columns]
    city = ["city"] if "city" in columns else []
    rows = features(merged.select(KEY, "ts", *city, *held), **options)
    return rows.dropna(subset=WARM_UP).select(KEY, "ts", *columns)


def extended_features(merged: DataFrame, **options) -> DataFrame:
    """The feature columns only earlier model generations use, with their ratios."""
    frames = feature_frames(merged, extended=True, **options)
    frames = frames.withColumns(feats.calendar()).withColumns(feats.extended_ratios())
    return frames


def complete(df: DataFrame, columns=FEATURES) -> DataFrame:
    """Rows with every model input present."""
    return df.dropna(how="any", subset=[c for c in columns if c in df.columns])
