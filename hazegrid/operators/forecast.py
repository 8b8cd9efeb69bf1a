"""From the newest complete row of each station to its next 72 hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.functions import index as aqi
from hazegrid.functions.features import display, model_column
from hazegrid.operators.chunks import KEY
from hazegrid.plans.features import complete
from hazegrid.schemas import (ALERT_LEVEL, HISTORY_DAYS, HORIZONS, MAX_LEAD, MODEL_INPUTS,
                              PREDICTION_RANGE)


def latest_rows(df: DataFrame) -> DataFrame:
    """Each station's newest row; copies are reduced before the shuffle."""
    rest = [c for c in df.columns if c not in (KEY, "ts")]
    newest = df.groupBy(KEY).agg(F.max(F.struct("ts", *rest)).alias("row"))
    return newest.select(KEY, "row.*").select(*df.columns)


def latest_complete(df: DataFrame) -> DataFrame:
    """Each station's newest row with every model input present."""
    return latest_rows(complete(df))


def last_n(df: DataFrame, n: int) -> DataFrame:
    """Each station's newest ``n`` rows (small n: the limit applies before the shuffle)."""
    newest = Window.partitionBy(KEY).orderBy(F.desc("ts"))
    return df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")


def context_slice(df: DataFrame, marks: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows at or before each station's mark."""
    return last_n(df.join(marks, KEY).filter("ts <= mark").drop("mark"), n)


def history(df: DataFrame, days: int = HISTORY_DAYS) -> DataFrame:
    """Rows of the last days before each station's newest row."""
    ends = df.groupBy(KEY).agg(F.max("ts").alias("_end"))
    cutoff = F.col("_end") - F.make_dt_interval(F.lit(days))
    return df.join(ends, KEY).filter(F.col("ts") >= cutoff).drop("_end")


def block_of(hours_ahead="hours_ahead") -> Column:
    """Forecast day (1, 2, 3) of a lead time."""
    h = F.col(hours_ahead)
    out = F.lit(None).cast("int")
    for day, (first, last) in HORIZONS.items():
        out = F.when(h.between(first, last), F.lit(day)).otherwise(out)
    return out


def expand_leads(latest: DataFrame, first: int = 1, last: int = MAX_LEAD) -> DataFrame:
    return latest.withColumn("hours_ahead", F.explode(F.sequence(F.lit(first), F.lit(last))))


def model_input(rows: DataFrame, names=MODEL_INPUTS) -> DataFrame:
    """Inputs in manifest order, lead-time terms computed."""
    return rows.select(KEY, "ts", *[model_column(n).alias(n) for n in names])


def finish(predictions: DataFrame, delta: bool | Column = False) -> DataFrame:
    """Raw predictions to the forecast table: level, clip, round, category, valid time."""
    delta = F.lit(delta) if isinstance(delta, bool) else delta
    level = F.when(delta, F.col("prediction") + F.col("aqi")).otherwise(F.col("prediction"))
    clipped = predictions.withColumn("_level", aqi.clip(level, PREDICTION_RANGE))
    return clipped.select(
        KEY, "hours_ahead",
        F.timestamp_seconds(F.unix_timestamp("ts") + F.col("hours_ahead") * 3600).alias("ts"),
        block_of().alias("day"), F.rint("_level").cast("long").alias("aqi"),
        aqi.category("_level").alias("category"), aqi.colour("_level").alias("colour"))


def persistence_forecast(table: DataFrame) -> DataFrame:
    latest = latest_complete(table).select(KEY, "ts", "aqi")
    return finish(expand_leads(latest).withColumn("prediction", F.col("aqi")))


def daily_summary(forecast: DataFrame) -> DataFrame:
    """One row per station and forecast day, from the hourly predictions."""
    daily = forecast.groupBy(KEY, "day").agg(
        F.to_date(F.min("ts")).alias("date"),
        F.rint(F.avg("aqi")).cast("long").alias("mean_aqi"),
        F.min("aqi").alias("min_aqi"), F.max("aqi").alias("max_aqi"),
        # the earliest of equally bad hours
        F.max_by("ts", F.struct(F.col("aqi"), -F.col("hours_ahead"))).alias("worst_hour"))
    return daily.select(
        KEY, "day", "date", "mean_aqi", "min_aqi", "max_aqi",
        aqi.category("mean_aqi").alias("category"), aqi.colour("mean_aqi").alias("colour"),
        "worst_hour")


def alerts(forecast: DataFrame, level: int = ALERT_LEVEL) -> DataFrame:
    """Stations whose worst forecast hour reaches the alert level."""
    worst = forecast.groupBy(KEY).agg(F.max_by(
        F.struct("ts", "hours_ahead", "aqi", "category"),
        F.struct(F.col("aqi"), -F.col("hours_ahead"))).alias("worst"))
    return worst.select(KEY, "worst.*").filter(F.col("aqi") >= level)


def every_sixth_hour(forecast: DataFrame) -> DataFrame:
    return forecast.filter(F.col("hours_ahead") % 6 == 0)


def forecast_slice(forecast: DataFrame, *, day: int | None = None,
                   hours_ahead: int | None = None) -> DataFrame:
    if day is not None:
        forecast = forecast.filter(F.col("day") == day)
    if hours_ahead is not None:
        forecast = forecast.filter(F.col("hours_ahead") == hours_ahead)
    return forecast


def history_cards(table: DataFrame) -> DataFrame:
    """Mean (cut to whole), highest, lowest and count of the last 24, 168 and 720 rows."""
    newest = Window.partitionBy(KEY).orderBy(F.desc("ts"))
    recent = table.select(KEY, "ts", "aqi").withColumn("n", F.row_number().over(newest))
    recent = recent.filter(F.col("n") <= 720)
    spans = recent.withColumn("span_hours", F.explode(F.filter(
        F.array(F.lit(24), F.lit(168), F.lit(720)), lambda s: s >= F.col("n"))))
    return spans.groupBy(KEY, "span_hours").agg(
        F.floor(F.avg("aqi")).cast("long").alias("mean_aqi"), F.max("aqi").alias("highest"),
        F.min("aqi").alias("lowest"), F.count(F.lit(1)).alias("readings"))


def sparkline(table: DataFrame, pollutants, hours: int = 48) -> DataFrame:
    """The last 48 values of each pollutant, missing shown as 0, and scaled to 0..1."""
    recent = last_n(table.select(KEY, "ts", *pollutants), hours)
    long = recent.select(KEY, "ts", F.inline(F.array(*[
        F.struct(F.lit(p).alias("pollutant"),
                 display(F.coalesce(p, F.lit(0.0)), 1).alias("value")) for p in pollutants])))
    rows = long.groupBy(KEY, "pollutant").agg(
        F.sort_array(F.collect_list(F.struct("ts", "value"))).alias("points"))
    values = rows.select(KEY, "pollutant", F.transform("points", lambda p: p["value"]).alias("values"))
    low, high = F.array_min("values"), F.array_max("values")
    span = F.greatest(high - low, F.lit(1e-6))
    return values.withColumn("scaled", F.transform("values", lambda v: (v - low) / span))
