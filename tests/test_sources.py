"""Feeds, stored tables, models, snapshots: written, read back, replayed."""

import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from series import START, readings, sorted_pandas, to_spark

from hazegrid.operators import forecast, frame, models, quality
from hazegrid.plans.features import build_features
from hazegrid.schemas import AVERAGING, FEATURES, MODEL_INPUTS, POLLUTANT_SCHEMA
from hazegrid.session import new_folder, shared_folder, written
from hazegrid.sources import feeds, registry, snapshot, tables
from hazegrid.streaming import collector, live


@pytest.fixture(scope="module")
def table(spark):
    return build_features(to_spark(spark, readings(900, stations=(1, 2), seed=31, present=0.95))).cache()


def test_pollutant_landing(spark, tmp_path):
    doc = {"station_id": 4, "list": [
        {"dt": 1609459200, "components": {"pm2_5": 5.5, "pm10": -9999, "no2": 1}},
        {"dt": 1609462800, "components": {"pm2_5": 6.0, "o3": 80}}]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    rows = feeds.read_pollutant_landing(spark, str(tmp_path)).orderBy("ts").collect()
    assert [r.pm2_5 for r in rows] == [5.5, 6.0] and rows[0].pm10 is None and rows[1].nh3 is None
    assert rows[0].station_id == 4 and str(rows[1].ts) == "2021-01-01 01:00:00"


def test_weather_landing(spark, tmp_path):
    doc = {"station_id": 4, "hourly": {"time": ["2021-01-01T00:00", "2021-01-01T01:00:00+00:00"],
                                       "temperature_2m": [1.5, None], "cloud_cover": [3, 4]}}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    rows = feeds.read_weather_landing(spark, str(tmp_path)).orderBy("ts").collect()
    assert [r.temperature for r in rows] == [1.5, None] and rows[1].clouds == 4.0
    assert rows[0].humidity is None and str(rows[1].ts) == "2021-01-01 01:00:00"


def test_csv_scan_and_merge(spark, tmp_path):
    df = pd.DataFrame({"station_id": 1, "ts": ["2021-01-01T00:10:00+00:00", "2021-01-01T00:50:00+00:00"],
                       "city": "c", "pm2_5": [1.0, 2.0]})
    for c in POLLUTANT_SCHEMA.names[4:]:
        df[c] = 1.0
    df.to_csv(tmp_path / "p.csv", index=False)
    raw = feeds.read_raw(spark, str(tmp_path / "p.csv"), POLLUTANT_SCHEMA, "csv")
    poll = raw.withColumn("arrival", F.col("pm2_5"))
    wx = raw.select("station_id", "ts", F.lit(1).alias("arrival"),
                    *[F.lit(1.0).alias(c) for c in feeds.WEATHER])
    out = feeds.merge_sources(poll, wx).collect()
    assert len(out) == 1 and out[0].pm2_5 == 2.0 and out[0].ts.minute == 0


def test_versions_are_kept_and_upserts_replayed(spark, table):
    path = new_folder(spark, "versions")
    tables.write_version(table, path, 2)
    tables.write_version(table.filter("station_id = 1"), path, 3)
    assert tables.versions(spark, path) == [2, 3]
    with pytest.raises(Exception):
        tables.write_version(table, path, 2)
    assert tables.read_version(spark, path, 2).count() == table.count()
    part = table.filter("station_id = 2").withColumn("aqi", F.lit(1.0))
    for _ in range(2):
        tables.upsert_version(part, path, 3)
    back = tables.read_version(spark, path)
    assert back.count() == table.count()
    assert back.filter("station_id = 2 and aqi <> 1").count() == 0
    assert back.groupBy("station_id", "ts").count().filter("count > 1").count() == 0


def test_marks_tell_absent_from_empty(spark, table):
    path = new_folder(spark, "marks")
    assert tables.table_mark(spark, path, 1) is None
    tables.write_version(table.limit(0), path, 1)
    assert tables.table_mark(spark, path, 1).count() == 0


def test_fresher_but_tiny_copy_is_not_taken(spark, table):
    tiny = table.withColumn("ts", F.col("ts") + F.expr("interval 90 days")).limit(5)
    chosen = {r.chosen for r in tables.pick_source(table, tiny).collect()}
    assert chosen == {"primary"}
    assert "candidate" in {r.chosen for r in tables.pick_source(table, tiny, complete=False).collect()}


def test_registry_serves_the_newest_version(spark, table, tmp_path):
    examples = frame.training_frame(table, 1, 24)
    model = models.ridge(examples)
    root = str(tmp_path / "models")
    scores = {"r2": .9, "rmse": 1., "mae": 1., "baseline_r2": .8}
    for expected in (1, 2):
        version = registry.register(model, root, name="day1", type="absolute", algorithm="Ridge",
                                    block=(1, 24), features=MODEL_INPUTS, scores=scores)
        assert version == expected
    loaded, row = registry.load(spark, root, "day1")
    assert row.version == 2 and row.improvement == pytest.approx(0.1)
    registry.check_features(row.features, table)
    with pytest.raises(ValueError):
        registry.check_features(row.features, table.drop("aqi"))
    inputs = forecast.model_input(forecast.expand_leads(forecast.latest_complete(table), 1, 24),
                                  row.features)
    assert loaded.transform(inputs).count() == 48
    assert registry.list_versions(registry.manifest(spark, root)).count() == 2


def test_snapshot_roundtrip(spark, table):
    ahead = forecast.persistence_forecast(table)
    served = spark.createDataFrame([("day1", 1, "absolute", .9, 1., 1.)],
                                   "model string, version long, type string, r2 double, "
                                   "rmse double, mae double")
    docs = snapshot.build_snapshot(table, ahead, served)
    path = new_folder(spark, "snap")
    snapshot.write_snapshot(docs, path)
    back = snapshot.read_snapshot(spark, path)
    assert back.count() == 2
    rows = snapshot.snapshot_table(back, "forecast")
    assert rows.count() == 144
    assert rows.select("ts").exceptAll(ahead.select("ts")).count() == 0
    doc = back.filter("station_id = 1").first()
    assert len(doc.pollutant_history["pm10"]) == 48 and len(doc.daily) == 3
    want = sorted_pandas(table.filter("station_id = 1"))
    assert doc.current.trend_6h == round(want.aqi.iloc[-1] - want.aqi.iloc[-7], 1)


def test_snapshot_reads_the_table_once(spark, table, capsys):
    """Newest row, trend, history and lines come out of one scan of few columns."""
    path = new_folder(spark, "table")
    tables.write_version(table, path, 1)
    ahead = written(forecast.persistence_forecast(table), "ahead")
    served = spark.createDataFrame([("day1", 1, "absolute", .9, 1., 1.)],
                                   "model string, version long, type string, r2 double, "
                                   "rmse double, mae double")
    docs = snapshot.build_snapshot(tables.read_version(spark, path, 1), ahead, served)
    docs.explain()
    plan = capsys.readouterr().out
    scans = [line for line in plan.split("\n") if "FileScan" in line and "day:int" not in line]
    assert len(scans) == 1 and "pm2_5" in scans[0] and "aqi_lag" not in scans[0]
    day = forecast.history(table).filter("station_id = 2 and aqi is not null")
    assert len(docs.filter("station_id = 2").first().history) == day.count()


def landed(df, number):
    """Readings of both feeds from merged rows, numbered by arrival."""
    out = []
    for feed, columns in collector.FEEDS.items():
        part = df[["station_id", "ts", "city", *columns]].copy()
        part["feed"], part["arrival"] = feed, number
        out.append(part)
    return pd.concat(out, ignore_index=True)


def test_collector_equals_batch_with_late_and_resent_hours(spark):
    df = readings(700, stations=(1, 2), seed=41, present=0.9, known=0.9, outage=(300, 330))
    late = df[(df.ts >= START + pd.Timedelta("350h")) & (df.ts < START + pd.Timedelta("380h"))]
    early = df.drop(late.index)
    first = early[early.ts < START + pd.Timedelta("500h")]
    second = early.drop(first.index)
    resent = first.tail(20).copy()
    resent["pm2_5"] = 399.0
    job = collector.Collector(new_folder(spark, "feeds"), [new_folder(spark, "live")])
    pieces = [(1, first), (2, second), (3, late), (4, resent), (4, resent)]
    for number, piece in pieces:
        job.apply(to_spark(spark, landed(piece, number)).select(
            *[F.col(f.name).cast(f.dataType) if f.name in landed(piece, 0).columns
              else F.lit(None).cast(f.dataType).alias(f.name)
              for f in collector.LANDING_SCHEMA.fields]), number)
    final = pd.concat([early, late, resent]).drop_duplicates(["station_id", "ts"], keep="last")
    want = sorted_pandas(build_features(to_spark(spark, final)))
    # nothing a batch wrote on the way is left behind
    scratch = os.listdir(new_folder(spark, "x").rsplit("/", 1)[0].removeprefix("file:"))
    assert not [n for n in scratch if n.split("-")[0] in
                ("batch", "changed", "observed", "reach", "outer", "stale", "fresh")]
    got = sorted_pandas(tables.read_version(spark, job.features[0]))
    assert len(want) == len(got)
    for c in ("aqi", "pm2_5", "aqi_lag_168h", "aqi_roll_std_7d", "precip_72h"):
        np.testing.assert_allclose(got[c], want[c], rtol=1e-12)


def landing(spark, piece, number):
    rows = landed(piece, number)
    return to_spark(spark, rows).select(
        *[F.col(f.name).cast(f.dataType) if f.name in rows.columns
          else F.lit(None).cast(f.dataType).alias(f.name) for f in collector.LANDING_SCHEMA.fields])


def test_collector_empties_months_that_failed_sensors_take_away(spark):
    df = readings(1500, stations=(1, 2), seed=43, present=0.95, known=0.95)
    failed = df[df.ts >= pd.Timestamp("2021-02-22")].copy()
    failed[collector.POLLUTANTS + collector.WEATHER] = -9999.0
    job = collector.Collector(new_folder(spark, "feeds"), [new_folder(spark, "live")])
    for number, piece in ((1, df), (2, failed), (2, failed)):
        job.apply(landing(spark, piece, number), number)
    final = df.copy()
    final.loc[final.ts >= pd.Timestamp("2021-02-22"), collector.POLLUTANTS + collector.WEATHER] = np.nan
    want = sorted_pandas(build_features(to_spark(spark, final)))
    got = tables.read_version(spark, job.features[0])
    assert got.filter("ts >= '2021-03-02'").count() == 0 and got.filter("ts is null").count() == 0
    got = sorted_pandas(got)
    assert len(want) == len(got)
    np.testing.assert_allclose(got.aqi, want.aqi)


def test_destinations_take_batches_in_any_order(spark, table):
    path = new_folder(spark, "sink")
    cuts = ["2021-01-20", "2021-01-29", "2021-02-02"]
    parts = [table.filter(F.col("ts") >= cuts[2]),
             table.filter((F.col("ts") >= cuts[1]) & (F.col("ts") < cuts[2])),
             table.filter(F.col("ts") < cuts[1])]
    for part in [*parts, parts[0]]:
        collector.append_missing(part, path, 1)
    got = tables.read_version(spark, path, 1)
    assert got.count() == table.count() and got.exceptAll(tables.storable(table).select(
        *got.columns)).count() == 0


def test_lags_of_hours_in_any_order(spark):
    df = pd.DataFrame({"station_id": 1, "aqi": np.arange(400.0)})
    df["ts"] = START + pd.to_timedelta(np.arange(400), unit="h")
    path, job = new_folder(spark, "index"), live.LagTable(new_folder(spark, "h"), new_folder(spark, "l"))
    for part in (df[300:], df[150:151], df[:150], df[151:300], df[150:151]):
        to_spark(spark, part).write.mode("append").parquet(path)
    stream = (spark.readStream.schema("station_id long, aqi double, ts timestamp")
              .option("maxFilesPerTrigger", 3).parquet(path))
    job.run(stream, new_folder(spark, "cp"))
    got = job.table(spark).toPandas().sort_values("ts").reset_index(drop=True)
    for h in (1, 24, 168):
        np.testing.assert_allclose(got[f"aqi_lag_{h}h"], df.aqi.shift(h))


def test_late_hours_are_taken_within_the_stated_lateness_and_counted_beyond(spark):
    df = pd.DataFrame({"station_id": 1, "pm2_5": np.arange(200.0) % 7})
    df["ts"] = START + pd.to_timedelta(np.arange(200), unit="h")
    tail = pd.DataFrame({"station_id": [-1], "pm2_5": [0.0], "ts": [START + pd.Timedelta("90d")]})
    want = df.pm2_5.rolling(24, min_periods=18).mean().dropna()
    for late, complete in (("200 hours", True), ("3 hours", False)):
        path, out = new_folder(spark, "hours"), new_folder(spark, "averages")
        for part in (df[120:], df[60:120], df[:60], tail):
            to_spark(spark, part).coalesce(1).write.mode("append").parquet(path)
        stream = (spark.readStream.schema("station_id long, pm2_5 double, ts timestamp")
                  .option("maxFilesPerTrigger", 1).parquet(path))
        dropped = live.run_to_parquet(live.hourly_averages(stream, "pm2_5", late), out,
                                      new_folder(spark, "cp"))
        got = spark.read.parquet(out).filter("station_id = 1 and ts < '2021-01-09 08:00:00'")
        assert (dropped == 0) == complete
        if complete:
            np.testing.assert_allclose(got.toPandas().sort_values("ts").average, want)


def test_panes_take_hours_of_any_age(spark):
    """Newest first, an hour sent again, a year-old hour and a replay: averages as in one piece."""
    rng = np.random.default_rng(8)
    hours = START + pd.to_timedelta(np.arange(2200), unit="h")  # longer than a chunk
    df = pd.DataFrame({"station_id": 1, "ts": hours, **{
        p: np.where(rng.random(2200) < 0.2, np.nan, rng.random(2200) * 90) for p in AVERAGING}})
    old = pd.DataFrame({"station_id": 1, "ts": START - pd.Timedelta("400d"), **dict.fromkeys(AVERAGING, 5.0)},
                       index=[0])
    wrong = df[1990:2010].assign(pm2_5=1e6)
    job = live.PaneTable(new_folder(spark, "panes"), new_folder(spark, "averages"))
    pieces = [df[2050:], wrong, old, df[1000:2050], df[:1000], df[1990:2010]]
    for i, piece in enumerate(pieces):
        batch = to_spark(spark, piece)
        job.apply(batch, i)
    job.apply(batch, i)
    job.apply(batch.filter("false"), i + 1)
    got = job.table(spark).toPandas().sort_values("ts").reset_index(drop=True)
    whole = pd.concat([old, df]).reset_index(drop=True)
    assert list(got.ts) == list(whole.ts)
    for p, (span, least) in AVERAGING.items():
        want = whole.set_index("ts")[p].rolling(f"{span}h", min_periods=least).mean()
        np.testing.assert_allclose(got[f"{p}_avg"], want, equal_nan=True)


def test_duplicates_are_dropped_and_their_state_with_the_watermark(spark):
    ts = START + pd.to_timedelta(np.arange(400) // 2, unit="h")
    df = pd.DataFrame({"station_id": 1, "ts": ts})
    path, out = new_folder(spark, "dups"), new_folder(spark, "unique")
    for i in range(0, 400, 100):
        to_spark(spark, df[i:i + 100]).repartition(2).write.mode("append").parquet(path)
    stream = (spark.readStream.schema("station_id long, ts timestamp")
              .option("maxFilesPerTrigger", 2).parquet(path))
    query = (live.drop_duplicates(stream, "24 hours").writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", new_folder(spark, "cp"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 200
    assert sum(op.numRowsRemoved for p in query.recentProgress for op in p.stateOperators) > 0


def test_stored_months_are_pruned(spark, table, capsys):
    path = new_folder(spark, "table")
    tables.write_version(table, path, 1)
    first, last = tables.months_of(tables.with_month(table.filter("ts >= '2021-02-02'")))
    tables.read_months(spark, path, 1, first=first, last=last).explain()
    plan = capsys.readouterr().out
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "month_start" in filters and ">= 2021-02-01" in filters


def test_model_input_must_match_the_manifest(spark, table):
    registry.check_model_input(["aqi", "hour"], table.select("aqi", "hour"))
    for columns in (["hour", "aqi"], ["aqi"], ["aqi", "hour", "pm10"]):
        with pytest.raises(ValueError):
            registry.check_model_input(["aqi", "hour"], table.select(*columns))


def test_features_are_picked_by_type(spark, table):
    extra = table.withColumn("target_day1", F.lit(1.0)).withColumn("note", F.lit("x"))
    assert tables.numeric_features(extra) == FEATURES


def test_names_are_normalised(spark):
    df = spark.createDataFrame([(1, 2.0)], "`PM 2-5 Mean` long, `Wind Speed` double")
    assert tables.normalise_names(df).columns == ["pm_2_5_mean", "wind_speed"]


def test_too_small_a_table_is_not_trained_on(spark, table):
    with pytest.raises(ValueError):
        models.train_block(table, 1, {"Ridge": models.ridge})


def test_staleness(spark, table):
    now = F.lit(START + pd.Timedelta(days=400)).cast("timestamp")
    assert quality.staleness(table, now, 48).filter("not stale").count() == 0


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def applied(spark, pieces):
    job = collector.Collector(new_folder(spark, "feeds"), [new_folder(spark, "live")])
    for number, piece in pieces:
        job.apply(landing(spark, piece, number), number)
    return job


def test_an_old_and_a_fresh_reading_rebuild_two_short_stretches(spark):
    df = readings(9000, stations=(1, 2), seed=47, present=0.97, known=0.97)
    old = df[(df.station_id == 1) & (df.ts >= START + pd.Timedelta("1000h"))].head(1).copy()
    old["pm2_5"] = 333.0
    new = df[df.ts >= START + pd.Timedelta("8990h")]
    early = df.drop(new.index)
    job = applied(spark, [(1, early)])
    piece = pd.concat([old, new], ignore_index=True)
    batch = written(collector.clean_sentinel(collector.to_hour(landing(spark, piece, 2))), "batch")
    changed = collector.changed_hours(batch)
    assert sorted((r.station_id, r.low == r.high) for r in changed.collect()) == [
        (1, False), (1, True), (2, False)]
    job.apply(batch, 2)
    fresh, stale = job.rebuilt(spark, changed)
    assert stale.count() == 3
    # two stretches of station 1 and one of station 2, none longer than look-back and some slack
    assert 200 < fresh.count() < 3 * 400
    final = pd.concat([df, old]).drop_duplicates(["station_id", "ts"], keep="last")
    want = sorted_pandas(build_features(to_spark(spark, final)))
    got = sorted_pandas(tables.read_version(spark, job.features[0]))
    assert len(want) == len(got)
    for c in ("aqi", "pm2_5", "aqi_lag_168h", "aqi_roll_std_7d", "precip_72h"):
        np.testing.assert_allclose(got[c], want[c], rtol=1e-12)


def test_stretches_merge(spark):
    rows = [(1, 0, 5), (1, 3, 9), (1, 12, 14), (1, 30, 31), (2, 7, 7)]
    got = collector.merged_ranges(spark.createDataFrame(rows, "station_id long, low long, high long"), 4)
    assert sorted(map(tuple, got.collect())) == [(1, 0, 14), (1, 30, 31), (2, 7, 7)]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("stop_at", ["deleted", "unfinished"])
def test_a_stopped_commit_loses_nothing(spark, monkeypatch, stop_at):
    df = readings(1600, stations=(1, 2), seed=53, present=0.95, known=0.95)
    late = df[(df.ts >= START + pd.Timedelta("700h")) & (df.ts < START + pd.Timedelta("760h"))]
    early = df.drop(late.index)
    job = applied(spark, [(1, early)])
    feed, version = job._path("pollutants"), job.version
    before = job._feed(spark, "pollutants").count()

    def failing(spark_, waiting, target):
        # what a commit does first to a folder, and then no more
        fs, at = tables._files(spark_, target)
        fs.delete(at(target), True)
        raise Stopped

    with monkeypatch.context() as patch:
        if stop_at == "unfinished":
            patch.setattr(tables, "finish_swap", lambda *a: None)
        patch.setattr(tables, "_put_in_place", failing)
        if stop_at == "unfinished":
            job._store(spark, "pollutants", landing(spark, late, 2).filter("feed = 'pollutants'").select(
                "station_id", "ts", "arrival", "city", *collector.POLLUTANTS))
            # the write itself was cut off: no marker
            fs, at = tables._files(spark, feed)
            fs.delete(at(f"{tables.pending_path(feed, version)}/_SUCCESS"), False)
        else:
            with pytest.raises(Stopped):
                job.apply(landing(spark, late, 2), 2)
    # readers see the new table, or the old one where the write had not ended
    now = job._feed(spark, "pollutants").count()
    assert now == (before if stop_at == "unfinished" else len(df))
    job.apply(landing(spark, late, 2), 2)
    want = sorted_pandas(build_features(to_spark(spark, df)))
    got = sorted_pandas(tables.read_version(spark, job.features[0]))
    assert len(want) == len(got)
    for c in ("aqi", "pm2_5", "aqi_lag_168h", "precip_72h"):
        np.testing.assert_allclose(got[c], want[c], rtol=1e-12)
    fs, at = tables._files(spark, feed)
    assert not fs.exists(at(tables.pending_path(feed, version)))


def test_stations_share_folders_and_keep_their_rows(spark, tmp_path):
    """Many stations take few folders; changing one leaves the others of its folder as they are."""
    from hazegrid.functions.features import epoch_hour
    from hazegrid.schemas import FEATURE_SCHEMA
    raw = to_spark(spark, readings(60, stations=range(130), seed=3, present=1.0))
    fields = {f.name: f.dataType for f in FEATURE_SCHEMA}
    path = str(tmp_path / "shared")
    tables.write_version(raw.select(*[
        (F.col(c) if c in raw.columns else F.lit(None)).cast(kind).alias(c) for c, kind in fields.items()]),
        path, 1)
    assert len(list((tmp_path / "shared" / "version=1").glob("*=*"))) == 3

    def rows():
        counts = tables.read_version(spark, path, 1).groupBy("station_id").agg(F.count("ts").alias("n"))
        return {r["station_id"]: r["n"] for r in counts.collect()}

    before = rows()
    assert before == dict.fromkeys(range(130), 60)
    one, hour = tables.read_version(spark, path, 1).filter("station_id = 7"), epoch_hour("ts")
    stale = written(one.groupBy("station_id").agg(F.min(hour).alias("low"), (F.min(hour) + 9).alias("high")),
                    "stale")
    fresh = written(one.orderBy("ts").limit(3), "fresh")
    collector.replace_hours(fresh, stale, path, 1)
    assert rows() == before | {7: 53}
