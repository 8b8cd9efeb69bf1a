"""Data-quality reports. One aggregation reads all columns; reports are a few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.functions.features import epoch_hour
from hazegrid.operators.chunks import KEY, with_previous
from hazegrid.operators.dedupe import ROW_KEY
from hazegrid.operators.quantiles import exact_quantiles
from hazegrid.schemas import SENSORS, SENTINEL


def per_column(df: DataFrame, columns, measures: dict, keep=()) -> DataFrame:
    """Several aggregates of many columns as one row per column.

    ``measures`` maps a name to a function from column name to aggregate; the aggregates
    may also use the columns in ``keep``. Rows are spread over the columns and reduced
    again inside the scan's stage, so one partial result per column and task is shuffled
    and the aggregation stays compiled however many columns there are.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    each = df.select(*keep, F.posexplode(values).alias("_at", "value"))
    found = each.groupBy("_at").agg(*[fn("value").alias(name) for name, fn in measures.items()])
    names = F.array(*[F.lit(c) for c in columns])
    return found.select(names[F.col("_at")].alias("column"), *measures)


def coverage(df: DataFrame) -> DataFrame:
    """Hours expected between first and last reading, present, missing and share."""
    hour = epoch_hour("ts")
    spans = df.groupBy(KEY).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        (F.max(hour) - F.min(hour) + 1).alias("expected"),
        F.count(F.lit(1)).alias("present"))
    missing = F.col("expected") - F.col("present")
    return spans.select("*", missing.alias("missing"),
                        (missing * 100.0 / F.col("expected")).alias("missing_pct"))


def gap_report(df: DataFrame) -> DataFrame:
    """Gaps between neighbouring rows of a station: how many, and the longest in hours."""
    before = with_previous(df.select(KEY, "ts"), ["ts"])
    gap = epoch_hour("ts") - epoch_hour("prev_ts")
    return before.groupBy(KEY).agg(F.count_if(gap > 1).alias("gaps"),
                                   F.max(gap).alias("largest_gap_hours"))


def null_report(df: DataFrame, columns=SENSORS) -> DataFrame:
    columns = [c for c in columns if c in df.columns]
    return per_column(df, columns, {
        "nulls": lambda c: F.count_if(F.col(c).isNull()),
        "null_pct": lambda c: F.count_if(F.col(c).isNull()) * 100.0 / F.count(F.lit(1))})


def sentinel_report(df: DataFrame, columns=SENSORS, sentinel: float = SENTINEL) -> DataFrame:
    columns = [c for c in columns if c in df.columns]
    return per_column(df, columns, {
        "sentinels": lambda c: F.count_if(F.col(c) == sentinel),
        "sentinel_pct": lambda c: F.count_if(F.col(c) == sentinel) * 100.0 / F.count(F.lit(1))})


def dupe_report(df: DataFrame, keys=ROW_KEY, row=None) -> DataFrame:
    """Rows beyond the first of each key, and beyond the first of each whole row."""
    row = list(row or df.columns)
    whole = df.groupBy(*row).agg(F.count(F.lit(1)).alias("n"))
    by_key = whole.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("same"))
    return by_key.agg(F.sum("n").alias("rows"),
                      F.sum(F.col("n") - 1).alias("duplicate_keys"),
                      F.sum("same").alias("duplicate_rows"))


def describe(df: DataFrame, columns=SENSORS) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column."""
    columns = [c for c in columns if c in df.columns]
    moments = per_column(df, columns, {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns])))
    marks = quartiles(long, ["column"], "value")
    return moments.join(marks, "column").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def quartiles(df: DataFrame, groups, value: str) -> DataFrame:
    long = exact_quantiles(df, groups, value, [0.25, 0.5, 0.75])
    return long.groupBy(*groups).agg(*[
        F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name)
        for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))])


def high_water_mark(df: DataFrame) -> DataFrame:
    """Newest hour per station."""
    return df.groupBy(KEY).agg(F.max("ts").alias("mark"))


def staleness(df: DataFrame, now, limit_hours: int) -> DataFrame:
    """Age of each station's newest row at ``now`` (a Column), and whether it is stale."""
    marks = high_water_mark(df)
    age = (F.unix_timestamp(now) - F.unix_timestamp("mark")) / F.lit(3600.0)
    return marks.select(KEY, "mark", age.alias("age_hours"),
                        (age > limit_hours).alias("stale"))


def verify_table(df: DataFrame) -> DataFrame:
    """What landed: rows, columns and time range."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.lit(len(df.columns)).cast("long").alias("columns"),
                  F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def split_drift(df: DataFrame, value: str, split: str = "split") -> DataFrame:
    """Distribution of a column in each part of a split."""
    moments = df.groupBy(split).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    return moments.join(quartiles(df, [split], value), split)
