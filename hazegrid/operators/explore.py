"""Exploratory aggregates over the feature table and the hourly index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.functions.features import SECTOR_DEGREES, epoch_hour
from hazegrid.functions.index import BANDS, SCALES
from hazegrid.operators.chunks import CHUNK_HOURS, KEY, add_halo, drop_halo, with_previous
from hazegrid.operators.quantiles import exact_quantiles, quantile_columns
from hazegrid.schemas import MAX_LEAD

# --- fixed values: columns of the correlation chart and of the response curves ---
CORRELATED = ["aqi", "aqi_lag_1h", "aqi_lag_24h", "aqi_lag_72h", "aqi_roll_mean_1d",
              "aqi_roll_mean_7d", "aqi_trend_24h", "pm2_5", "pm10", "o3", "co", "no2",
              "temperature", "humidity", "wind_speed", "ventilation", "pressure",
              "precip_24h", "temp_range_24h"]
RESPONSES = ["wind_speed", "humidity", "temperature", "ventilation", "temp_range_24h",
             "pressure"]
BOXED = ["pm2_5", "pm10", "no2", "o3", "so2", "nh3"]
LEAST_FOR_RESPONSE = 100


def aqi_summary(df: DataFrame) -> DataFrame:
    """Mean, median, deviation and range of the index, and the years covered.

    The index is a whole number of a few thousand at most, so the median's value counts
    stay small whatever the number of rows.
    """
    days = F.floor((F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))) / 86400)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.avg("aqi").alias("mean"),
        F.percentile("aqi", F.lit(0.5)).alias("median"), F.stddev_samp("aqi").alias("std"),
        F.min("aqi").alias("min"), F.max("aqi").alias("max"), (days / 365.0).alias("years"))


def band_share(df: DataFrame) -> DataFrame:
    """Percentage of rows in each half-open band; 700 and above is in none."""
    index = F.col("aqi")
    held = df.agg(F.count(F.lit(1)).alias("total"), *[
        F.count_if((index >= low) & (index < high)).alias(f"b{i}")
        for i, (low, high, _) in enumerate(BANDS)])
    return held.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("band"),
                 (F.col(f"b{i}") * 100.0 / F.col("total")).alias("share_pct"))
        for i, (_, _, label) in enumerate(BANDS)])))


def dominant_share(df: DataFrame) -> DataFrame:
    counts = (df.filter("dominant_pollutant is not null")
              .groupBy("dominant_pollutant").agg(F.count(F.lit(1)).alias("hours")))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    # one row on the right: a total
    return counts.join(F.broadcast(total), how="inner").select(
        "dominant_pollutant", "hours", (F.col("hours") * 100.0 / F.col("total")).alias("share_pct"))


def dominant_by_month(df: DataFrame) -> DataFrame:
    """Share of each pollutant's hours within the month, one column per pollutant."""
    names = list(SCALES)
    counts = (df.filter("dominant_pollutant is not null")
              .groupBy(F.month("ts").alias("month"))
              .pivot("dominant_pollutant", names).agg(F.count(F.lit(1))))
    counts = counts.fillna(0, names)
    total = sum((F.col(n) for n in names), F.lit(0))
    return counts.select("month", *[(F.col(n) * 100.0 / total).alias(f"{n}_pct") for n in names])


def daily_timeline(hourly: DataFrame) -> DataFrame:
    """Daily mean of the index (empty days stay missing) and its 30-day mean.

    Hours are reduced to days before the per-station order; the 30-day mean needs ten
    days with a value.
    """
    daily = hourly.groupBy(KEY, F.to_date("ts").alias("date")).agg(
        F.avg("aqi").alias("daily_aqi"))
    month = (Window.partitionBy(KEY).orderBy("date")
             .rowsBetween(-29, Window.currentRow))
    return daily.select(
        "*", F.when(F.count("daily_aqi").over(month) >= 10,
                    F.avg("daily_aqi").over(month)).alias("mean_30d"))


def profile(df: DataFrame, part) -> DataFrame:
    """Mean and deviation of the index by a calendar part."""
    return df.groupBy(part).agg(F.avg("aqi").alias("mean"), F.stddev_samp("aqi").alias("std"))


def decile_response(df: DataFrame, columns=RESPONSES, bins: int = 10) -> DataFrame:
    """Mean index per decile of a column, right-closed bins, equal edges merged.

    Columns with fewer than 100 complete pairs are left out.
    """
    long = df.select("aqi", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns]))).filter("aqi is not null and value is not null")
    edges = (exact_quantiles(long, ["column"], "value", [i / bins for i in range(bins + 1)])
             .groupBy("column")
             .agg(F.array_sort(F.collect_set("quantile")).alias("edges")))
    # one row per column on the right
    placed = long.join(F.broadcast(edges), "column").withColumn(
        "bin", F.greatest(F.size(F.filter("edges", lambda e: e < F.col("value"))), F.lit(1)))
    per_bin = placed.groupBy("column", "bin").agg(
        F.max("edges").alias("edges"), F.avg("aqi").alias("mean_aqi"),
        F.count(F.lit(1)).alias("rows"))
    overall = long.groupBy("column").agg(F.corr("value", "aqi").alias("r"),
                                         F.count(F.lit(1)).alias("pairs"))
    low, high = (F.element_at("edges", F.col("bin") + i) for i in (0, 1))
    return (per_bin.join(F.broadcast(overall.filter(F.col("pairs") >= LEAST_FOR_RESPONSE)), "column")
            .select("column", "bin", ((low + high) / 2).alias("mid"), "mean_aqi", "rows", "r"))


def wind_rose(df: DataFrame) -> DataFrame:
    """Mean index per 22.5 degree sector, left-closed; 360 itself belongs to none."""
    whole = df.dropna(subset=["wind_deg", "wind_speed", "aqi"]).filter(
        (F.col("wind_deg") >= 0) & (F.col("wind_deg") < 360))
    sector = F.floor(F.col("wind_deg") / SECTOR_DEGREES).cast("int")
    return whole.groupBy(sector.alias("sector")).agg(
        F.avg("aqi").alias("mean_aqi"), F.count(F.lit(1)).alias("hours"))


def histogram(df: DataFrame, column: str = "aqi", bins: int = 80) -> DataFrame:
    """Equal-width counts between minimum and maximum; the last bin is closed."""
    known = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    ends = known.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    place = F.least(F.floor((F.col("v") - F.col("low")) / width), F.lit(bins - 1)).cast("int")
    # one row on the right: the range
    held = known.join(F.broadcast(ends), how="inner").groupBy(
        place.alias("bin"), "low", "high").agg(F.count(F.lit(1)).alias("hours"))
    return held.select("bin", (F.col("low") + F.col("bin") * width).alias("left_edge"), "hours")


def box_stats(df: DataFrame, columns=BOXED) -> DataFrame:
    """Quartiles and whiskers (furthest values within 1.5 times the box) per column."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns]))).filter("value is not null")
    marks = quantile_columns(long, ["column"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col("value")
    # one row per column on the right
    return long.join(F.broadcast(marks), "column").groupBy("column", "q1", "median", "q3").agg(
        F.min(F.when(v >= F.col("q1") - reach, v)).alias("whisker_low"),
        F.max(F.when(v <= F.col("q3") + reach, v)).alias("whisker_high"),
        F.count_if((v < F.col("q1") - reach) | (v > F.col("q3") + reach)).alias("outliers"))


def corr_matrix(df: DataFrame, columns=CORRELATED) -> DataFrame:
    """Pairwise-complete Pearson correlations in one pass, one row per pair.

    Each row is spread over the pairs inside the scan's stage and reduced there again;
    only one partial result per pair and task is shuffled.
    """
    columns = [c for c in columns if c in df.columns]
    values = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("values"))
    left = values.select("values", F.posexplode("values").alias("a", "x")).filter("x is not null")
    both = left.select("a", "x", F.posexplode("values").alias("b", "y")).filter(
        "b > a and y is not null")
    found = both.groupBy("a", "b").agg(F.corr("x", "y").alias("r"))
    names = F.array(*[F.lit(c) for c in columns])
    return found.select(names[F.col("a")].alias("left_column"),
                        names[F.col("b")].alias("right_column"), "r")


def target_corr(df: DataFrame, target: str, columns) -> DataFrame:
    """Correlation of every column with the target, strongest positive first."""
    wide = df.agg(*[F.corr(c, target).alias(c) for c in columns])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("r")) for c in columns])))
    return long.orderBy(F.desc("r"))


def with_leads(hourly: DataFrame, hours, column: str = "aqi",
               size: int = CHUNK_HOURS) -> DataFrame:
    """Later values of a dense hourly series as columns ``lead_<h>``."""
    frames = add_halo(hourly.withColumn("hour", epoch_hour("ts")), ahead=max(hours), size=size)
    w = Window.partitionBy(KEY, "chunk").orderBy("hour")
    frames = frames.withColumns({f"lead_{h}": F.lead(column, h).over(w) for h in hours})
    return drop_halo(frames, size).drop("hour", "chunk")


def autocorrelation(hourly: DataFrame, lags=range(1, MAX_LEAD + 1)) -> DataFrame:
    """Correlation of the index with itself some hours later, and pairs used."""
    lags = list(lags)
    led = with_leads(hourly.select(KEY, "ts", "aqi"), lags)
    each = led.filter("aqi is not null").select("aqi", F.inline(F.array(*[
        F.struct(F.lit(h).alias("lag_hours"), F.col(f"lead_{h}").alias("later"))
        for h in lags])))
    return each.groupBy("lag_hours").agg(F.corr("aqi", "later").alias("r"),
                                         F.count("later").alias("pairs"))


def jump_report(df: DataFrame, versions: dict) -> DataFrame:
    """Hour-to-hour behaviour of several index versions (label -> column) side by side."""
    columns = list(versions.values())
    steps = with_previous(df.select(KEY, "ts", *columns), columns)
    later = with_leads(steps, [24], columns[0]).withColumnRenamed("lead_24", "_later_0")
    for i, c in enumerate(columns[1:], 1):
        later = with_leads(later, [24], c).withColumnRenamed("lead_24", f"_later_{i}")
    packed = []
    for i, (label, c) in enumerate(versions.items()):
        jump = F.abs(F.col(c) - F.col(f"prev_{c}"))
        packed.append(F.struct(
            F.lit(label).alias("version"), F.count_if(F.col(c) == 500).alias("at_500"),
            F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.percentile(jump, F.lit(0.5)).alias("median_jump"),
            F.avg(jump).alias("mean_jump"), F.count_if(jump > 100).alias("jumps_over_100"),
            F.corr(c, f"_later_{i}").alias("corr_24h")).alias(f"v{i}"))
    return later.agg(*packed).select(F.inline(F.array(*[f"v{i}" for i in range(len(columns))])))
