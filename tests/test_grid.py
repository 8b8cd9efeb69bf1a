"""Grid, interpolation and windows against pandas, and chunked against whole."""

import numpy as np
import pandas as pd
import pytest
from series import readings, sorted_pandas, to_spark

from hazegrid.operators.grid import hourly_grid, interpolate
from hazegrid.plans.features import build_features, features, hourly_index
from hazegrid.schemas import FEATURES, SENSORS


def pandas_grid(df):
    out = []
    for s, g in df.groupby("station_id"):
        g = g.set_index("ts").sort_index()
        full = pd.date_range(g.index.min(), g.index.max(), freq="h")
        g = g.reindex(full)
        g["station_id"] = s
        g.index.name = "ts"
        out.append(g.reset_index())
    return pd.concat(out, ignore_index=True)


def pandas_filled(df):
    out = []
    for _, g in pandas_grid(df).groupby("station_id"):
        g = g.set_index("ts")
        g[SENSORS] = g[SENSORS].interpolate(method="time", limit=3, limit_direction="both")
        out.append(g.reset_index())
    return pd.concat(out, ignore_index=True)


@pytest.mark.parametrize("size", [24, 100, 2016])
def test_interpolation_matches_pandas(spark, size):
    df = readings(700, stations=(1, 2), seed=3, present=0.5, known=0.6, outage=(200, 420))
    ours = sorted_pandas(interpolate(to_spark(spark, df), size=size))
    theirs = pandas_filled(df).sort_values(["station_id", "ts"]).reset_index(drop=True)
    assert len(ours) == len(theirs)
    for c in SENSORS:
        np.testing.assert_allclose(ours[c], theirs[c], rtol=1e-12, atol=1e-12)


def test_grid_has_every_hour_once(spark):
    df = readings(500, stations=(1, 2, 3), seed=5, present=0.4)
    grid = sorted_pandas(hourly_grid(to_spark(spark, df), size=48))
    span = df.groupby("station_id")["ts"].agg(lambda t: (t.max() - t.min()) / pd.Timedelta("1h") + 1)
    assert grid.groupby("station_id").size().tolist() == span.astype(int).tolist()
    assert not grid.duplicated(["station_id", "ts"]).any()


def test_whole_gap_mode_leaves_long_gaps(spark):
    df = readings(100, seed=1, present=1.0, known=1.0, outage=(40, 45))
    both = sorted_pandas(interpolate(to_spark(spark, df)))
    whole = sorted_pandas(interpolate(to_spark(spark, df), mode="whole_gap"))
    assert both["pm10"].isna().sum() == 0
    assert whole["pm10"].isna().sum() == 5


def reference_features(df):
    out = []
    for _, g in pandas_filled(df).groupby("station_id"):
        g = g.reset_index(drop=True)
        g["pressure_trend_24h"] = g["pressure"] - g["pressure"].shift(24)
        t = g["temperature"].rolling(24, min_periods=6)
        g["temp_range_24h"] = t.max() - t.min()
        g["precip_72h"] = g["precipitation"].rolling(72, min_periods=12).sum()
        for c in ("pm2_5", "humidity"):
            g[f"{c}_roll_24h"] = g[c].rolling(24, min_periods=6).mean()
        g["o3_lag_24h"] = g["o3"].shift(24)
        out.append(g)
    return pd.concat(out, ignore_index=True)


def test_sensor_windows_match_pandas(spark):
    df = readings(500, stations=(1, 2), seed=8, present=0.7)
    ours = sorted_pandas(features(to_spark(spark, df), size=200))
    theirs = reference_features(df).sort_values(["station_id", "ts"]).reset_index(drop=True)
    for c in ("pressure_trend_24h", "temp_range_24h", "precip_72h", "pm2_5_roll_24h",
              "humidity_roll_24h", "o3_lag_24h"):
        np.testing.assert_allclose(ours[c], theirs[c], rtol=1e-6, atol=2e-6)


def test_index_windows_match_pandas(spark):
    df = readings(600, seed=11, present=0.9, known=0.9)
    ours = sorted_pandas(features(to_spark(spark, df), size=192))
    aqi = ours["aqi"]
    for h in (1, 24, 168):
        np.testing.assert_allclose(ours[f"aqi_lag_{h}h"], aqi.shift(h))
    for name, n in (("1d", 24), ("3d", 72), ("7d", 168)):
        r = aqi.rolling(n, min_periods=max(2, n // 4))
        np.testing.assert_allclose(ours[f"aqi_roll_mean_{name}"], r.mean(), rtol=1e-9)
        np.testing.assert_allclose(ours[f"aqi_roll_std_{name}"], r.std(), rtol=1e-6, atol=1e-6)
    np.testing.assert_allclose(ours["aqi_roll_max_1d"], aqi.rolling(24, min_periods=6).max())
    np.testing.assert_allclose(ours["aqi_vs_7d"], aqi - ours["aqi_roll_mean_7d"])


def test_chunked_equals_whole(spark):
    df = readings(1500, stations=(1, 2), seed=2, present=0.6, outage=(500, 760))
    rows = to_spark(spark, df)
    whole = sorted_pandas(build_features(rows, size=100000))
    chunked = sorted_pandas(build_features(rows, size=240))
    assert len(whole) == len(chunked) > 0
    for c in FEATURES:
        np.testing.assert_array_equal(whole[c], chunked[c])
    assert (whole["dominant_pollutant"].fillna("") == chunked["dominant_pollutant"].fillna("")).all()


def test_index_needs_enough_values(spark):
    df = readings(40, seed=4, present=1.0, known=1.0)
    df[["pm10", "co", "o3"]] = np.nan
    out = sorted_pandas(hourly_index(to_spark(spark, df)))
    assert out["aqi"].isna().sum() == 17 and out["dominant_pollutant"].iloc[20] == "pm2_5"


def _nodes(node):
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def test_no_window_over_a_whole_station(spark):
    """Readings are partitioned by station and chunk; only chunk summaries by station."""
    df = to_spark(spark, readings(300, seed=6))
    plan = build_features(df)._jdf.queryExecution().optimizedPlan()
    windows = [n for n in _nodes(plan) if n.nodeName() == "Window"]
    assert len(windows) >= 8
    for w in windows:
        if "chunk" not in w.partitionSpec().mkString(","):
            names = {w.child().output().apply(i).name() for i in range(w.child().output().size())}
            assert "hour" not in names


def test_tasks_follow_the_hours_of_the_grid(spark):
    """Pairs of readings far apart take few bytes and make a long grid."""
    from hazegrid.operators.chunks import TASK_ROWS
    from hazegrid.operators.grid import hourly_frames
    ends = readings(30, stations=range(12), seed=1, present=1.0).groupby("station_id").nth([0, -1])
    late = ends.groupby("station_id").cumcount() == 1
    df = ends.assign(ts=ends["ts"] + pd.to_timedelta(np.where(late, TASK_ROWS, 0), unit="h"))
    plan = hourly_frames(to_spark(spark, df))._jdf.queryExecution().optimizedPlan().toString()
    tasks = [int(line.rsplit(" ", 1)[1]) for line in plan.splitlines()
             if "RepartitionByExpression" in line and line.rsplit(" ", 1)[1].isdigit()]
    assert tasks and min(tasks) >= 12


def test_chunk_summaries_come_from_the_shuffled_readings(spark):
    """One exchange of readings: a summary ahead of it holds a wide row per file and chunk, which
    grows faster than the readings."""
    from hazegrid.operators.grid import filled_frames
    df = to_spark(spark, readings(300, stations=(1, 2), seed=6))
    query = filled_frames(df, back=24)._jdf.queryExecution()
    summaries = [n for n in _nodes(query.optimizedPlan()) if n.nodeName() == "Aggregate"
                 and "pm2_5__max_h" in n.output().mkString(",")]
    assert summaries
    for n in summaries:
        assert any(x.nodeName().startswith("RepartitionByExpression") for x in _nodes(n))
    dealt = [line for line in query.executedPlan().toString().splitlines()
             if "Exchange hashpartitioning" in line and "chunk" in line.split("),")[0]]
    assert dealt and all("REPARTITION_BY_NUM" in line for line in dealt)


def test_readings_of_two_cities_and_none(spark):
    """A missing hour has the city of the reading before it, the first ones their station's newest."""
    df = readings(200, stations=(1, 2), seed=9, present=0.6).sort_values(["station_id", "ts"])
    at = df.groupby("station_id").cumcount()
    df["city"] = np.where(at < 20, None, np.where(at < 60, "a", "b"))
    df.loc[df["station_id"] == 2, "city"] = None
    out = sorted_pandas(interpolate(to_spark(spark, df)))
    assert out.loc[out["station_id"] == 2, "city"].isna().all()
    one, known = out[out["station_id"] == 1], df[df["station_id"] == 1].set_index("ts")["city"]
    want = known.reindex(one["ts"]).ffill().fillna("b")
    assert one["city"].tolist() == want.tolist()
