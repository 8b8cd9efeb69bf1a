"""One named query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazegrid.functions import features as feats
from hazegrid.functions import index as aqi
from hazegrid.functions.labels import dashboard_labels, feature_label
from hazegrid.operators import dedupe, explain, explore, forecast, frame, metrics, models, quality
from hazegrid.operators import windows as win
from hazegrid.operators.chunks import KEY, fill_both_ways, last_rows, with_positions
from hazegrid.operators.grid import hourly_grid, interpolate
from hazegrid.plans import features as plan
from hazegrid.schemas import (EXPLAIN_ROWS, FEATURES, HORIZONS, LAGS, LEAD_INTERACTIONS,
                              MODEL_INPUTS, POLLUTANT_PAYLOAD, POLLUTANT_WINDOWS, POLLUTANTS, ROLLING, SENSORS,
                              TRENDS, WEATHER, WEATHER_MEANS, WEATHER_PAYLOAD)
from hazegrid.session import written
from hazegrid.sources import feeds, fixtures, registry, snapshot, tables
from hazegrid.sources.fixtures import ARRIVAL

#: Columns whose last digits differ between sine functions.
ROUNDED = ["hour_sin", "hour_cos", "month_sin", "month_cos", "wind_u", "wind_v"]

Query = Callable[[SparkSession, str], DataFrame]

#: "Now" for the age and gap reports, shortly after the last fixture hour.
NOW = "2021-04-17 00:00:00"
#: Hours by which the collector queries are behind the newest hour.
BEHIND_HOURS = 300


class Tables:
    """The pipeline's tables over one data folder, each written once per session.

    The stages pass on files, as the hourly jobs do: reports read the stored feature
    table instead of building it again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def pollutants(self) -> DataFrame:
        return fixtures.raw_pollutants(self.spark, self.folder)

    @cached_property
    def weather(self) -> DataFrame:
        return fixtures.raw_weather(self.spark, self.folder)

    @cached_property
    def merged(self) -> DataFrame:
        return written(fixtures.merged(self.spark, self.folder), "merged")

    @cached_property
    def hourly(self) -> DataFrame:
        return written(plan.hourly_index(self.merged), "hourly")

    @cached_property
    def features(self) -> DataFrame:
        return written(plan.build_features(self.merged), "features")

    def reading(self, *columns) -> DataFrame:
        """The feature table's rows for a report that reads ``columns`` alone.

        A session that has the whole table reads that; otherwise only these columns are made and
        written, from the sensors behind them.
        """
        columns = [c for c in dict.fromkeys(columns) if c not in (KEY, "ts")]
        if "features" in self.__dict__:
            return self.features.select(KEY, "ts", *columns)
        known = self.__dict__.setdefault("narrow", {})
        name = next((n for n in known if set(columns) <= set(n)), tuple(columns))
        if name not in known:
            known[name] = written(plan.build_columns(self._merged_for(columns), columns), "features")
        return known[name].select(KEY, "ts", *columns)

    def _merged_for(self, columns) -> DataFrame:
        """Merged readings of the sensors behind ``columns``."""
        if "merged" in self.__dict__:
            return self.merged
        city = ["city"] if "city" in columns else []
        wanted = tuple([*city, *plan.sensors_behind(columns)])
        known = self.__dict__.setdefault("narrow_merged", {})
        name = next((n for n in known if set(wanted) <= set(n)), wanted)
        if name not in known:
            rows = fixtures.merged(self.spark, self.folder).select(KEY, "ts", *wanted)
            known[name] = written(rows, "merged")
        return known[name]

    @property
    def features_once(self) -> DataFrame:
        """The feature table for a single pass over it: not written for that."""
        return self.features if "features" in self.__dict__ else plan.build_features(self.merged)

    @cached_property
    def leading(self) -> DataFrame:
        """What baselines need of the feature table; ``all_known`` is set where every feature is."""
        columns = dict.fromkeys(["aqi", *LEAD_INTERACTIONS, "aqi_roll_mean_3d", "aqi_lag_24h"])
        whole = " and ".join(f"{c} is not null" for c in FEATURES)
        table = self.features_once.select(KEY, "ts", *columns, F.expr(f"if({whole}, 1, null)").alias("all_known"))
        return table if "features" in self.__dict__ else written(table, "leading")

    def ahead(self) -> DataFrame:
        """The persistence forecast from each station's newest row that has every feature."""
        return forecast.persistence_forecast(self.leading.filter("all_known = 1").select(KEY, "ts", "aqi"))

    @cached_property
    def train_sums(self) -> dict:
        """Sums of all blocks' training and test examples, for every linear fit."""
        return models.train_sums(self.features)

    @cached_property
    def latest(self) -> DataFrame:
        """Each station's newest row that has every feature."""
        return written(forecast.latest_complete(self.features), "latest")

    @property
    def complete(self) -> DataFrame:
        return plan.complete(self.features)

    @property
    def marks(self) -> DataFrame:
        newest = quality.high_water_mark(self.reading())
        return newest.select(KEY, (F.col("mark") - F.make_dt_interval(
            hours=F.lit(BEHIND_HOURS))).alias("mark"))

    def given(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.folder, name)

    @property
    def events(self) -> DataFrame:
        cents = F.round(F.col("value") * 100).cast("long")
        return self.given("events").withColumns(
            {"cents": cents, "seconds": F.floor(F.unix_micros("ts") / 1000000).cast("long"),
             "k": F.get_json_object("props", "$.k").cast("long")})

    def naive_scores(self) -> DataFrame:
        return models.score_naive(self.test_examples())

    def examples(self, day: int, **options) -> DataFrame:
        return frame.training_frame(self.features, *HORIZONS[day], **options).withColumn(
            "block", F.lit(day))

    def all_examples(self, **options) -> DataFrame:
        """Examples of all blocks with the columns that baselines read."""
        return frame.training_frame(self.leading, 1, 72, features=self.leading.columns[2:],
                                    **options).withColumn("block", forecast.block_of())

    def test_examples(self, **options) -> DataFrame:
        return frame.chrono_split(self.all_examples(**options)).filter("split = 'test'")


_TABLES: dict[tuple[str, str], Tables] = {}


def tables_of(spark: SparkSession, folder: str) -> Tables:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _TABLES:
        fixtures.prepare(spark)
        _TABLES[key] = Tables(spark, folder)
    return _TABLES[key]


_REGISTERED: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Times without a zone (they are UTC), so that any engine shows the same value."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.typeName() in ("timestamp", "date") else F.col(f.name)
                       for f in df.schema.fields])


def query(fn: Callable[[Tables], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(fn(tables_of(spark, folder)))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _REGISTERED[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    from hazegrid.catalog import learned, streams  # noqa: F401  (they register theirs)
    return dict(_REGISTERED)


def rounded(df: DataFrame, decimals: int, *columns) -> DataFrame:
    return df.withColumns({c: F.round(c, decimals) for c in columns})


# ---------------------------------------------------------------- sources

def pollutant_documents(t: Tables) -> DataFrame:
    """One payload text per event: two readings, a failed sensor, an absent component."""
    def reading(shift):
        nh3 = F.when(F.col("event_type") == "signup", F.lit("")).otherwise(
            F.concat(F.lit(',"nh3":'), F.col("k").cast("string")))
        o3 = F.when(F.col("event_type") == "error", F.lit("-9999")).otherwise(
            (F.col("cents") * 3).cast("string"))
        return F.concat(
            F.lit('{"dt":'), (F.col("seconds") + shift).cast("string"),
            F.lit(',"components":{"pm2_5":'), F.col("cents").cast("string"),
            F.lit(',"pm10":'), (F.col("cents") * 2 + shift).cast("string"),
            F.lit(',"no2":'), F.col("k").cast("string"), F.lit(',"o3":'), o3,
            F.lit(',"co":null,"so2":'), (F.col("cents") + F.col("k")).cast("string"), nh3,
            F.lit("}}"))

    return t.events.select("event_id", F.concat(
        F.lit('{"list":['), reading(0), F.lit(","), reading(1800), F.lit("]}")).alias("text"))


@query
def flatten_readings(t):
    return feeds.flatten_readings(
        feeds.parse_payload(pollutant_documents(t), "text", POLLUTANT_PAYLOAD))


def weather_documents(t: Tables) -> DataFrame:
    hour = F.date_format("ts", "yyyy-MM-dd'T'HH")
    series = F.concat(F.lit("["), F.col("cents").cast("string"), F.lit(","),
                      F.col("k").cast("string"), F.lit("]"))
    clouds = F.when(F.col("event_type") == "error", F.lit("")).otherwise(
        F.concat(F.lit(',"cloud_cover":'), series))
    names = ["temperature_2m", "relative_humidity_2m", "pressure_msl", "wind_speed_10m",
             "wind_direction_10m", "precipitation"]
    return t.events.select("event_id", F.concat(
        F.lit('{"hourly":{"time":["'), hour, F.lit(':00","'), hour,
        F.lit(':30:00+00:00"]'), *[x for n in names for x in (F.lit(f',"{n}":'), series)],
        clouds, F.lit("}}")).alias("text"))


@query
def flatten_weather(t):
    return feeds.flatten_weather(
        feeds.parse_payload(weather_documents(t), "text", WEATHER_PAYLOAD))


@query
def clean_sentinel(t):
    return feeds.clean_sentinel(t.pollutants).select(*ARRIVAL, KEY, "ts", *POLLUTANTS)


@query
def drop_sentinel(t):
    return feeds.drop_sentinel(t.pollutants).select(*ARRIVAL, KEY, "ts", "pm10", "no2", "o3")


@query
def feature_sink_roundtrip(t):
    """Written as a version, read back: what landed per station."""
    from hazegrid.session import new_folder
    path = new_folder(t.spark, "feature-table")
    tables.write_version(t.features, path, 3)
    back = tables.read_version(t.spark, path)
    return back.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("rows"), F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"), F.sum("aqi").alias("aqi_sum"),
        F.sum("hour").alias("hour_sum"),
        F.count_if(F.col("dominant_pollutant") == "unknown").alias("unknown"))


@query
def feature_sink_columns(t):
    """Written as a version, read back: every row with every column."""
    from hazegrid.session import new_folder
    path = new_folder(t.spark, "feature-table")
    tables.write_version(t.features, path, 1)
    return rounded(tables.read_version(t.spark, path), 9, *ROUNDED)


@query
def high_water_mark(t):
    return quality.high_water_mark(t.reading())


@query
def verify_table(t):
    return quality.verify_table(t.features)


@query
def pick_source(t):
    """Two feeds as copies of one table: fresher and at least as complete wins."""
    return tables.pick_source(feeds.hourly_readings(t.pollutants, ARRIVAL),
                              feeds.hourly_readings(t.weather, ARRIVAL))


@query
def pick_source_recency(t):
    return tables.pick_source(feeds.hourly_readings(t.pollutants, ARRIVAL),
                              feeds.hourly_readings(t.weather, ARRIVAL), complete=False)


def _batch(t: Tables, late: bool) -> DataFrame:
    part = t.pollutants.filter(F.col("l_linenumber") > 4 if late else F.col("l_linenumber") <= 4)
    return feeds.hourly_readings(part, ARRIVAL).select(KEY, "ts", *POLLUTANTS)


@query
def upsert_keep_last(t):
    """The feed in two batches: the later one replaces hours both hold."""
    return dedupe.upsert(_batch(t, False), _batch(t, True))


@query
def backfill_plan(t):
    """Calendar-year pieces of every customer's first to last order."""
    spans = t.given("orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("stop"))
    return tables.year_chunks(spans).select("o_custkey", "chunk_start", "chunk_stop")


@query
def fetch_gap(t):
    """What each station is behind, the furthest of two destinations."""
    return tables.fetch_gap([quality.high_water_mark(t.reading()), t.marks],
                            F.lit(NOW).cast("timestamp"))


def weekly_manifest(t: Tables) -> DataFrame:
    """Weekly scores of the naive baseline per station stand in for model versions."""
    each = t.all_examples().select(
        KEY, "block", F.floor(feats.epoch_hour("ts") / 168).alias("week"),
        F.col("y").alias("actual"), F.col("aqi").alias("predicted"))
    scores = metrics.measure(each, [KEY, "block", "week"])
    return scores.select(
        F.format_string("station_%d_day%d", KEY, "block").alias("model"),
        F.col("week").alias("version"), "rmse", "mae", "examples")


@query
def model_features(t):
    """Inputs picked by type from a stored table's own schema, and how many rows hold each.

    The table has a text column, a column of a later value and a number of its own besides.
    """
    from hazegrid.session import new_folder
    path = new_folder(t.spark, "wider")
    tables.write_version(t.features.withColumns({
        "note": F.lit("seen"), "target_24h": F.col("aqi"), "spare reading": F.col("aqi") / 2}), path, 1)
    stored = t.spark.read.parquet(tables.version_path(path, 1))
    names = tables.numeric_features(stored)
    counts = stored.agg(*[F.count(c).alias(c) for c in names])
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(c).alias("present"))
        for i, c in enumerate(names)])))


@query
def normalised_names(t):
    """A feed whose columns have capitals, spaces and dashes, stored under plain names."""
    odd = t.weather.select(F.col(KEY).alias("Station-ID"), F.col("ts").alias("TS"), *[
        F.col(c).alias(c.replace("_", " ").title()) for c in WEATHER])
    stored = written(tables.storable(odd), "named")
    return stored.groupBy(KEY).agg(F.count("ts").alias("rows"), *[F.sum(c).alias(c) for c in WEATHER])


@query
def optional_columns(t):
    """Feeds merged with a weather feed that has the optional column and one that lacks it."""
    parts = []
    for feed, weather in (("with", t.weather), ("without", feeds.drop_optional(t.weather))):
        merged = feeds.merge_sources(t.pollutants, weather, ARRIVAL)
        parts.append(merged.groupBy(KEY).agg(
            F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in WEATHER]).select(
            F.lit(feed).alias("feed"), F.lit(len(merged.columns)).alias("columns"), "*"))
    return parts[0].unionByName(parts[1])


@query
def latest_model_version(t):
    return rounded(registry.latest_versions(weekly_manifest(t)), 6, "rmse", "mae")


@query
def list_model_versions(t):
    return rounded(registry.list_versions(weekly_manifest(t)), 6, "rmse", "mae")


def _documents(t: Tables) -> DataFrame:
    ahead = t.ahead()
    scores = metrics.select_model(t.naive_scores()).select(
        F.concat(F.lit("day"), F.col("block")).alias("model"), F.lit(1).cast("long").alias("version"),
        F.lit("absolute").alias("type"), *[F.round(c, 6).alias(c) for c in ("r2", "rmse", "mae")])
    return snapshot.build_snapshot(t.features, ahead, scores)


@query
def snapshot_document(t):
    return _documents(t).select(
        KEY, "predicted_from", "current.*",
        F.size("forecast").alias("forecast_hours"), F.size("daily").alias("days"),
        F.size("history").alias("history_hours"), F.size("models").alias("served_models")
    ).drop("pollutants", "ts")


@query
def snapshot_readback(t):
    """Documents written as JSON and read back as the forecast table."""
    from hazegrid.session import new_folder
    path = new_folder(t.spark, "snapshot")
    snapshot.write_snapshot(_documents(t), path)
    return snapshot.snapshot_table(snapshot.read_snapshot(t.spark, path), "forecast")


def _read_back(t: Tables) -> DataFrame:
    from hazegrid.session import new_folder
    path = new_folder(t.spark, "snapshot")
    snapshot.write_snapshot(_documents(t), path)
    return snapshot.read_snapshot(t.spark, path)


@query
def snapshot_daily(t):
    """The daily summary out of documents that were written and read back."""
    return snapshot.snapshot_table(_read_back(t), "daily")


@query
def snapshot_history(t):
    """30 days of the index out of documents that were written and read back."""
    return snapshot.snapshot_table(_read_back(t), "history")


@query
def snapshot_pollutants(t):
    """The last 48 values of each pollutant out of documents."""
    each = _read_back(t).select(KEY, F.explode("pollutant_history").alias("pollutant", "values"))
    return each.select(KEY, "pollutant", F.posexplode("values").alias("position", "value"))


# ------------------------------------------------- projections and filters

@query
def range_filter(t):
    return t.merged.filter(F.col("ts").between(F.lit("2021-02-01").cast("timestamp"),
                                               F.lit("2021-03-01").cast("timestamp")))


@query
def context_slice(t):
    return forecast.context_slice(t.reading(*SENSORS), t.marks, 200)


@query
def fresh_rows(t):
    fresh = tables.newer_than(t.reading("aqi", "aqi_lag_168h", "dominant_pollutant"), t.marks)
    return fresh.dropna(subset=["aqi", "aqi_lag_168h"]).select(
        KEY, "ts", "aqi", "aqi_lag_168h", "dominant_pollutant")


@query
def complete_rows(t):
    return plan.complete(t.features_once).select(KEY, "ts", "aqi", "aqi_roll_std_7d", "wind_speed", "precip_72h")


@query
def model_input(t):
    """Inputs of the newest complete row of each station at every lead time."""
    leads = forecast.expand_leads(forecast.latest_complete(t.features))
    out = forecast.model_input(leads)
    noisy = ["hour_sin", "hour_cos", "month_sin", "month_cos", "wind_u", "wind_v"]
    return rounded(out, 9, *noisy)


@query
def history_30d(t):
    return forecast.history(t.reading("aqi", *snapshot.SHOWN)).select(KEY, "ts", "aqi", *snapshot.SHOWN)


@query
def staleness(t):
    return quality.staleness(t.reading(), F.lit(NOW).cast("timestamp"), 48)


@query
def duplicate_rows(t):
    hours = feeds.to_hour(t.pollutants).select(KEY, "ts", "l_linenumber")
    return dedupe.all_duplicates(hours)


# ------------------------------------------------------------------- joins

@query
def merge_sources(t):
    return fixtures.merged(t.spark, t.folder)


@query
def hourly_grid_rows(t):
    return hourly_grid(t.merged)


@query
def sub_index(t):
    subs = aqi.sub_indices(pm2_5="pm2_5", pm10="pm10", co="co", o3="o3")
    clean = feeds.clean_sentinel(t.pollutants)
    each = clean.select(*ARRIVAL, KEY, *[c.alias(f"{p}_index") for p, c in subs.items()])
    named = {p: f"{p}_index" for p in subs}
    return each.select("*", aqi.overall(named.values()).alias("aqi"),
                       aqi.dominant(named).alias("dominant_pollutant"))


# ------------------------------------------------------------ aggregations

@query
def coverage(t):
    return quality.coverage(t.merged)


@query
def gap_report(t):
    return quality.gap_report(t.merged)


@query
def null_report(t):
    return quality.null_report(t.merged)


@query
def dupe_report(t):
    hours = feeds.to_hour(t.pollutants).select(KEY, "ts", "l_linenumber")
    return quality.dupe_report(hours)


@query
def sentinel_report(t):
    return quality.sentinel_report(t.pollutants, POLLUTANTS)


@query
def describe(t):
    return rounded(quality.describe(t.merged), 6, "mean", "std", "q25", "q50", "q75")


@query
def aqi_summary(t):
    return rounded(explore.aqi_summary(t.reading("aqi")), 6, "mean", "median", "std", "years")


@query
def band_share(t):
    return explore.band_share(t.reading("aqi"))


@query
def dominant_share(t):
    return explore.dominant_share(t.reading("dominant_pollutant"))


@query
def dominant_by_month(t):
    return explore.dominant_by_month(t.reading("month", "dominant_pollutant"))


@query
def daily_timeline(t):
    return rounded(explore.daily_timeline(t.hourly), 6, "daily_aqi", "mean_30d")


@query
def profile_hour(t):
    return rounded(explore.profile(t.reading("aqi", "hour"), "hour"), 6, "mean", "std")


@query
def profile_month(t):
    return rounded(explore.profile(t.reading("aqi", "month"), "month"), 6, "mean", "std")


@query
def decile_response(t):
    return rounded(explore.decile_response(t.features), 6, "mid", "mean_aqi", "r")


@query
def wind_rose(t):
    return rounded(explore.wind_rose(t.reading("aqi", "wind_deg", "wind_speed")), 6, "mean_aqi")


@query
def histogram(t):
    return rounded(explore.histogram(t.reading("aqi")), 6, "left_edge")


@query
def box_stats(t):
    return rounded(explore.box_stats(t.features), 6, "q1", "median", "q3")


@query
def corr_matrix(t):
    return rounded(explore.corr_matrix(t.features), 6, "r")


TARGET_INPUTS = ["hour", "day", "month", "day_of_week", "is_weekend", *POLLUTANTS,
                 *[f"aqi_lag_{h}h" for h in (1, 3, 6, 12, 24, 48, 72)],
                 "aqi_roll_mean_3d", "aqi_roll_mean_7d"]


@query
def target_corr(t):
    led = explore.with_leads(t.hourly.select(KEY, "ts", "aqi"), [24])
    target = led.select(KEY, "ts", F.col("lead_24").alias("target_day1"))
    table = t.reading(*TARGET_INPUTS).join(target, [KEY, "ts"])
    return rounded(explore.target_corr(table, "target_day1", TARGET_INPUTS), 6, "r")


@query
def autocorrelation(t):
    return rounded(explore.autocorrelation(t.hourly), 6, "r")


@query
def metrics_persistence(t):
    each = t.test_examples().select("block", F.col("y").alias("actual"),
                                    F.col("aqi").alias("predicted"))
    return rounded(metrics.measure(each, ["block"]), 6, "rmse", "mae", "r2", "prediction_spread")


@query
def r2_by_hour(t):
    each = t.test_examples().select("block", "hours_ahead", F.col("y").alias("actual"),
                                    F.col("aqi").alias("predicted"))
    return rounded(metrics.r2_by_hour(each, ["block"]), 6, "r2")


@query
def swing(t):
    """How far a trend-following prediction moves in a block, against what happened."""
    guess = F.col("aqi") + F.col("aqi_trend_24h") * F.col("hours_ahead") / 72.0
    each = t.test_examples().select(KEY, "block", "row_nr", F.col("y").alias("actual"),
                                    guess.alias("predicted"))
    return rounded(metrics.swing(each, ["block"]), 6, "predicted_swing", "actual_swing")


@query
def daily_summary(t):
    return forecast.daily_summary(t.ahead())


@query
def history_cards(t):
    return forecast.history_cards(t.reading("aqi"))


@query
def index_before_after(t):
    """The index read from single hours (before) and from averages (after)."""
    subs = aqi.sub_indices(pm2_5="pm2_5", pm10="pm10", co="co", o3="o3")
    single = t.hourly.select(KEY, "ts", "aqi", *[c.alias(p) for p, c in subs.items()])
    both = single.select(KEY, "ts", aqi.overall(subs).alias("aqi_before"),
                         F.col("aqi").alias("aqi_after"))
    out = explore.jump_report(both, {"before": "aqi_before", "after": "aqi_after"})
    return rounded(out, 6, "mean", "std", "median_jump", "mean_jump", "corr_24h")


@query
def split_drift(t):
    numbered = with_positions(frame.day_targets(t.hourly.select(KEY, "ts", "aqi"))
                              .filter("target_day1 is not null and aqi is not null"))
    out = quality.split_drift(frame.chrono_split(numbered), "target_day1")
    return rounded(out, 6, "mean", "std", "q25", "q50", "q75")


# ----------------------------------------------------------------- windows

@query
def aqi_hourly(t):
    return plan.hourly_index(t.merged).select(
        KEY, "ts", "aqi", "dominant_pollutant")


def _features(t: Tables, columns) -> DataFrame:
    return plan.features(t.merged).select(KEY, "ts", *columns)


@query
def aqi_lags(t):
    return _features(t, ["aqi", *[f"aqi_lag_{h}h" for h in LAGS]])


@query
def aqi_rolling(t):
    names = [f"aqi_roll_{s}_{n}" for n, _, _ in ROLLING for s in ("mean", "std")]
    return _features(t, [*names, "aqi_roll_max_1d", "aqi_roll_min_1d", "aqi_range_1d"])


@query
def aqi_trends(t):
    return _features(t, [*[f"aqi_trend_{h}h" for h in TRENDS], "aqi_vs_7d"])


@query
def pollutant_windows(t):
    return _features(t, [f"{p}_{k}_24h" for p in POLLUTANT_WINDOWS for k in ("lag", "roll")])


@query
def weather_windows(t):
    return _features(t, ["pressure_trend_24h", "temp_range_24h", "precip_24h", "precip_72h",
                         *[f"{c}_roll_24h" for c in WEATHER_MEANS]])


@query
def interpolated(t):
    return interpolate(t.merged)


@query
def interpolated_whole_gaps(t):
    return interpolate(t.merged, mode="whole_gap").drop("city")


@query
def ffill_bfill(t):
    """Cities and wind of the hourly grid carried over missing hours."""
    grid = hourly_grid(t.merged, ["wind_deg", "pm2_5"])
    return fill_both_ways(grid, ["wind_deg", "pm2_5"])


@query
def dedupe_last(t):
    return dedupe.keep_last(feeds.to_hour(t.pollutants).select(KEY, "ts", *ARRIVAL, "so2"),
                            arrival=ARRIVAL)


@query
def dedupe_first(t):
    return dedupe.keep_first(feeds.to_hour(t.pollutants).select(KEY, "ts", *ARRIVAL, "so2"),
                             arrival=ARRIVAL)


@query
def day_targets(t):
    return frame.day_targets(t.hourly.select(KEY, "ts", "aqi"))


EXTENDED = ["aqi_rolling_3d", "aqi_rolling_7d", "aqi_rolling_3d_std", "aqi_rolling_7d_std",
            "aqi_std_24h", "aqi_max_24h", "aqi_min_24h", "aqi_median_24h", "aqi_range_24h",
            *[f"aqi_change_{h}h" for h in (1, 3, 6, 24)],
            *[f"aqi_lag1_trend_{h}h" for h in (6, 12, 24)],
            *[f"aqi_lag24_trend_{h}h" for h in (48, 72)],
            *[f"{c}_{k}24" for c in win.EXTENDED_WEATHER for k in ("lag", "diff")],
            "persistence_24h", "persistence_48h", "persistence_72h",
            "hour_x_weekend", "pm_ratio", "co_no2_ratio"]


@query
def extended_features(t):
    out = plan.extended_features(t.merged).select(KEY, "ts", *EXTENDED)
    return rounded(out, 6, "hour_x_weekend", "pm_ratio", "co_no2_ratio")


@query
def sparkline(t):
    out = forecast.sparkline(t.reading(*snapshot.SHOWN), snapshot.SHOWN)
    each = out.select(KEY, "pollutant", F.posexplode(F.arrays_zip("values", "scaled")))
    return each.select(KEY, "pollutant", F.col("pos").alias("position"),
                       F.round("col.values", 1).alias("value"),
                       F.round("col.scaled", 6).alias("scaled"))


@query
def chrono_split(t):
    return frame.chrono_split(with_positions(t.reading()))


@query
def chrono_split_time(t):
    return frame.chrono_split(t.reading(), mode="time")


# ------------------------------------------------------------ sorts, top-k

@query
def latest_complete(t):
    return forecast.latest_complete(t.features).select(
        KEY, "ts", "aqi", "dominant_pollutant", "aqi_lag_168h", "aqi_roll_std_7d")


@query
def recent_sample(t):
    """The newest 2000 complete rows of each station."""
    return last_rows(t.complete.select(KEY, "ts", "aqi"), EXPLAIN_ROWS)


@query
def select_model(t):
    out = metrics.select_model(t.naive_scores())
    return rounded(out, 6, "r2", "rmse", "mae", "baseline_r2", "improvement")


def delta_scores(t: Tables) -> DataFrame:
    """Baselines that predict a change from the current index, scored on its level."""
    each = t.test_examples(delta=True)
    guesses = {"Persistence": F.lit(0.0), "Trend goes on": F.col("aqi_trend_24h") * 0.25,
               "Back to the week": F.col("aqi_vs_7d") * -0.5}
    long = each.select("block", (F.col("y") + F.col("aqi")).alias("actual"), F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), (F.col("aqi") + g).alias("predicted"))
        for n, g in guesses.items()])))
    return metrics.measure(long, ["block", "model"])


@query
def compare_models(t):
    out = metrics.compare_models(metrics.select_model(t.naive_scores()),
                                 metrics.select_model(delta_scores(t)))
    return rounded(out, 6, "absolute_r2", "absolute_rmse", "delta_r2", "delta_rmse")


# ----------------------------------------------------------------- scalars

@query
def categories(t):
    value = ((F.col("cents") * 7) % 90000) / 100.0 - 5.0
    v = F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(value)
    return t.events.select("event_id", v.alias("value")).select(
        "*", aqi.category("value").alias("category"), aqi.colour("value").alias("colour"))


@query
def time_features(t):
    parts = feats.calendar()
    out = t.events.select("event_id", *[c.alias(n) for n, c in parts.items()])
    return rounded(out, 9, "hour_sin", "hour_cos", "month_sin", "month_cos")


@query
def weather_features(t):
    out = t.merged.select(KEY, "ts", *[c.alias(n) for n, c in feats.weather().items()])
    return rounded(out, 9, "wind_u", "wind_v", "ventilation")


@query
def feature_labels(t):
    """Labels of all inputs, with how often the table holds a value for them."""
    # a row per input, written as it is read twice
    counts = written(quality.per_column(t.features_once, FEATURES, {"values": F.count}), "counts")
    leads = counts.filter(F.col("column").isin("aqi", "aqi_trend_24h", "aqi_roll_std_1d")).select(
        F.concat("column", F.lit("_x_hours")).alias("column"), "values")
    both = counts.unionByName(leads)
    return both.select("column", "values", feature_label("column").alias("label"),
                       feature_label("column", dashboard_labels()).alias("dashboard_label"))


# ------------------------------------------------------------- forecasting

@query
def feature_table(t):
    out = plan.build_features(t.merged)
    return rounded(out, 9, *ROUNDED)


def _frame_sums(examples: DataFrame) -> DataFrame:
    return examples.groupBy(KEY, "hours_ahead").agg(
        F.count(F.lit(1)).alias("examples"), F.sum("y").alias("y_sum"),
        F.sum("row_nr").alias("row_nr_sum"), F.sum("aqi_x_hours").alias("aqi_x_hours"),
        F.sum("aqi_trend_24h_x_hours").alias("trend_24h_x_hours"),
        F.sum("aqi_trend_72h_x_hours").alias("trend_72h_x_hours"),
        F.round(F.max("sqrt_hours_ahead"), 9).alias("sqrt_hours_ahead"))


@query
def training_frame(t):
    """All examples of the three blocks, summed per station and lead time."""
    return _frame_sums(t.all_examples())


@query
def training_frame_inputs(t):
    """Every model input of all examples, in whole thousandths, summed per station and lead."""
    examples = frame.training_frame(t.features, 1, 72)
    return examples.groupBy(KEY, "hours_ahead").agg(*[
        F.sum(F.floor(F.col(c) * 1000 + 0.5)).alias(f"in_{c}") for c in MODEL_INPUTS
        if c != "hours_ahead"])


@query
def training_frame_by_row(t):
    return _frame_sums(t.all_examples(target_mode="row"))


@query
def delta_target(t):
    return t.all_examples(delta=True).groupBy(KEY, "block").agg(
        F.count(F.lit(1)).alias("examples"), F.sum("y").alias("change_sum"),
        F.sum(F.abs("y")).alias("change_size"), F.min("y").alias("largest_fall"),
        F.max("y").alias("largest_rise"))


@query
def naive_baselines(t):
    return rounded(t.naive_scores(), 6, "rmse", "mae", "r2", "prediction_spread")


@query
def forecast_persistence(t):
    return t.ahead()


@query
def forecast_slices(t):
    return forecast.every_sixth_hour(t.ahead())


@query
def forecast_one_hour(t):
    return forecast.forecast_slice(t.ahead(), hours_ahead=18)


@query
def alerts(t):
    return forecast.alerts(t.ahead())


def slopes(table: DataFrame, inputs) -> DataFrame:
    """Single-input slopes against the index and input means, one row per input."""
    each = quality.per_column(table, inputs, {
        "slope": lambda c: F.covar_pop(c, "aqi") / F.nullif(F.var_pop(c), F.lit(0.0)),
        "mean": F.avg}, keep=["aqi"])
    return each.select(F.col("column").alias("feature"),
                       (F.floor(F.coalesce("slope", F.lit(0.0)) * 1024) / 1024)
                       .alias("coefficient"), (F.floor(F.col("mean") * 64) / 64).alias("mean"))


ATTRIBUTED = ["aqi_lag_1h", "aqi_lag_24h", "aqi_roll_mean_7d", "aqi_trend_24h", "pm2_5", "pm10",
              "o3", "co", "no2", "temperature", "humidity", "pressure", "precip_24h",
              "temp_range_24h", "hour", "day_of_week"]


def _attributed(t: Tables) -> DataFrame:
    rows = last_rows(t.complete.select(KEY, "ts", *ATTRIBUTED), EXPLAIN_ROWS)
    return explain.linear_attribution(rows, ATTRIBUTED, slopes(t.features, ATTRIBUTED))


@query
def linear_attribution(t):
    """Contributions of a linear rule, summed per station over its newest 2000 rows."""
    out = _attributed(t).groupBy(KEY, "feature").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("contribution").alias("total"),
        F.max("contribution").alias("largest"), F.min("contribution").alias("smallest"))
    return rounded(out, 3, "total", "largest", "smallest")


@query
def top_drivers(t):
    out = explain.top_drivers(_attributed(t), [KEY]).select(
        KEY, "feature", "label", "rank", "mean_abs")
    return rounded(out, 3, "mean_abs")


@query
def explanation_contents(t):
    """Both lists of the explanation documents of a linear rule, written and read back."""
    from hazegrid.session import new_folder
    path, latest = new_folder(t.spark, "explained"), t.latest
    parts = written(_attributed(t), "parts")
    predicted = parts.groupBy(KEY, "ts").agg(F.sum("contribution").alias("prediction"))
    entry = explain.horizon(parts, latest, predicted, F.lit(0.0), day=1, model="Linear rule",
                            hours_ahead=12)
    snapshot.write_snapshot(explain.explanation_documents(latest, [entry]), path)
    each = snapshot.read_explanations(t.spark, path).select(
        KEY, "explained_from", "current_aqi", F.inline("horizons"))
    lists = [each.select(KEY, "explained_from", "current_aqi", F.lit(name).alias("list"),
                         F.inline(name)).withColumnRenamed(amount, "amount")
             for name, amount in (("global_importance", "mean_abs"),
                                  ("current_explanation", "contribution"))]
    return rounded(lists[0].unionByName(lists[1]), 3, "amount")
