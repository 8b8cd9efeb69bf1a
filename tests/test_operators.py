"""Operators against brute force on small data, and with one dominating station."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from series import START, readings, sorted_pandas, to_spark

from hazegrid.operators import dedupe, explain, explore, forecast, frame, metrics, models, quality
from hazegrid.operators.chunks import fill_both_ways, last_rows, with_positions, with_previous
from hazegrid.operators.quantiles import exact_quantiles
from hazegrid.plans.features import build_features, complete
from hazegrid.schemas import FEATURES, MODEL_INPUTS


def hours(spark, values, station=1, start=START):
    df = pd.DataFrame({"station_id": station, "aqi": np.asarray(values, float)})
    df["ts"] = start + pd.to_timedelta(np.arange(len(df)), unit="h")
    return to_spark(spark, df)


@pytest.fixture(scope="module")
def table(spark):
    rows = to_spark(spark, readings(1100, stations=(1, 2), seed=21, present=0.95, known=0.97))
    return build_features(rows).cache()


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(0)
    hot = pd.DataFrame({"g": "hot", "v": np.round(rng.lognormal(3, 2, 20000), 3)})
    ties = pd.DataFrame({"g": "ties", "v": rng.integers(0, 5, 3000).astype(float)})
    one = pd.DataFrame({"g": "one", "v": [7.5]})
    df = pd.concat([hot, ties, one], ignore_index=True)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(spark.createDataFrame(df), ["g"], "v", ps).toPandas()
    for g, part in df.groupby("g"):
        for p in ps:
            mine = got[(got.g == g) & (got.p == p)]["quantile"].item()
            assert mine == pytest.approx(part.v.quantile(p), rel=1e-12, abs=1e-12)


def test_positions_previous_and_last_rows(spark):
    df = pd.concat([readings(900, stations=(1,), seed=1, present=0.3),
                    readings(40, stations=(2,), seed=2)])[["station_id", "ts", "pm10"]]
    rows = to_spark(spark, df)
    want = df.sort_values(["station_id", "ts"]).reset_index(drop=True)
    got = sorted_pandas(with_positions(rows, size=48))
    assert got.row_nr.tolist() == want.groupby("station_id").cumcount().tolist()
    got = sorted_pandas(with_previous(rows, ["ts", "pm10"], size=48))
    pd.testing.assert_series_equal(got.prev_ts, want.groupby("station_id").ts.shift(1),
                                   check_names=False, check_dtype=False)
    np.testing.assert_allclose(got.prev_pm10, want.groupby("station_id").pm10.shift(1))
    got = sorted_pandas(last_rows(rows, 30))
    tail = want.groupby("station_id").tail(30)
    assert got.ts.tolist() == tail.ts.tolist()


def test_fill_both_ways(spark):
    df = readings(400, stations=(1, 2), seed=9, known=0.05)[["station_id", "ts", "pm10"]]
    got = sorted_pandas(fill_both_ways(to_spark(spark, df), ["pm10"], size=24))
    want = df.sort_values(["station_id", "ts"]).reset_index(drop=True)
    filled = want.groupby("station_id").pm10.transform(lambda s: s.ffill().bfill())
    np.testing.assert_allclose(got.pm10, filled)


def test_keep_last_reduces_a_hot_key_before_the_shuffle(spark):
    """One reading sent a million times costs one row per task after the first stage."""
    hot = spark.range(1_000_000).select(
        F.lit(1).cast("long").alias("station_id"), F.lit(START).cast("timestamp").alias("ts"),
        F.col("id").alias("arrival"), (F.col("id") % 7).cast("double").alias("pm10"))
    out = dedupe.keep_last(hot)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") == 1
    row = out.collect()
    assert len(row) == 1 and row[0].arrival == 999_999
    assert dedupe.keep_first(hot).first().arrival == 0


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (1, "a")], "k long, v string")
    assert sorted(r.copy for r in dedupe.all_duplicates(df).collect()) == [1, 2, 3]
    row = quality.dupe_report(df.withColumnRenamed("k", "station_id"), keys=["station_id"]).first()
    assert tuple(row) == (5, 3, 2)


def test_explanation_documents(spark):
    """Lists are ranked by size, entries by day; a station nothing explains keeps its document."""
    start, hour = START.to_pydatetime(), pd.Timedelta(hours=1).to_pytimedelta()
    parts = spark.createDataFrame(
        [(1, start + h * hour, f, c) for h, f, c in
         ((0, "aqi", 5.0), (0, "pm10", -9.0), (1, "aqi", 3.0), (1, "pm10", -1.0))],
        "station_id long, ts timestamp, feature string, contribution double")
    latest = spark.createDataFrame([(1, start + hour, 104.6), (2, start, 7.0)],
                                   "station_id long, ts timestamp, aqi double")
    predicted = latest.select("station_id", "ts", F.lit(12.0).alias("prediction"))
    entries = [explain.horizon(parts, latest, predicted, F.lit(10.0), day=d, model="m",
                               hours_ahead=24 * d - 12) for d in (3, 1)]
    one, two = explain.explanation_documents(latest, entries).orderBy("station_id").collect()
    assert (one.current_aqi, one.explained_from) == (105, start + hour)
    assert [(h.day, h.hours_ahead, h.gap) for h in one.horizons] == [(1, 12, 0.0), (3, 60, 0.0)]
    first = one.horizons[0]
    assert [(r.rank, r.feature, r.mean_abs) for r in first.global_importance] == [
        (1, "pm10", 5.0), (2, "aqi", 4.0)]
    assert [(r.rank, r.feature, r.contribution) for r in first.current_explanation] == [
        (1, "aqi", 3.0), (2, "pm10", -1.0)]
    assert two.horizons is None and two.current_aqi == 7


def test_gap_report_across_chunks(spark):
    df = pd.DataFrame({"station_id": 1, "ts": START + pd.to_timedelta([0, 1, 5, 9000], unit="h")})
    row = quality.gap_report(spark.createDataFrame(df)).first()
    assert (row.gaps, row.largest_gap_hours) == (2, 8995)


def test_training_frame_by_time_and_by_row(spark):
    values = pd.DataFrame({"station_id": 1, "at": [0, 1, 2, 5, 6], "aqi": [10., 11., 12., 15., 16.]})
    values["ts"] = START + pd.to_timedelta(values["at"], unit="h")
    for c in ("aqi_trend_24h", "aqi_trend_72h", "aqi_roll_std_1d", "aqi_vs_7d"):
        values[c] = 1.0
    rows = spark.createDataFrame(values.drop(columns="at"))
    inputs = ["aqi", "aqi_trend_24h", "aqi_trend_72h", "aqi_roll_std_1d", "aqi_vs_7d"]
    by_time = frame.training_frame(rows, 1, 3, features=inputs).toPandas()
    pairs = set(zip(by_time.aqi, by_time.hours_ahead, by_time.y))
    assert pairs == {(10, 1, 11), (10, 2, 12), (11, 1, 12), (12, 3, 15), (15, 1, 16)}
    by_row = frame.training_frame(rows, 1, 3, features=inputs, target_mode="row").toPandas()
    pairs = set(zip(by_row.aqi, by_row.hours_ahead, by_row.y))
    assert (12, 1, 15) in pairs and (10, 3, 15) in pairs and len(pairs) == 4 + 3 + 2
    change = frame.training_frame(rows, 1, 3, features=inputs, delta=True).toPandas()
    assert set(change.y) == {1.0, 2.0, 3.0}


def test_examples_of_a_row_stay_on_one_side(spark, table):
    examples = frame.chrono_split(frame.training_frame(table, 1, 24))
    sides = examples.groupBy("station_id", "row_nr").agg(F.countDistinct("split").alias("n"))
    assert sides.filter("n > 1").count() == 0
    parts = {r["split"]: r["count"] for r in examples.groupBy("split").count().collect()}
    assert parts["train"] > 3 * parts["test"] > 0
    apart = frame.chrono_split(frame.training_frame(table, 1, 24), embargo_rows=24)
    assert apart.filter("split = 'embargo'").count() > 0


def test_metrics_match_their_definition(spark):
    rng = np.random.default_rng(5)
    y, p = rng.integers(0, 300, 500).astype(float), rng.normal(150, 300, 500)
    df = spark.createDataFrame(pd.DataFrame({"actual": y, "predicted": p}))
    row = metrics.measure(df, []).first()
    c = np.clip(p, 0, 700)
    assert row.rmse == pytest.approx(np.sqrt(((c - y) ** 2).mean()))
    assert row.mae == pytest.approx(np.abs(c - y).mean())
    assert row.r2 == pytest.approx(1 - ((c - y) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row.prediction_spread == pytest.approx(np.std(p))


def test_baseline_winning_is_refused(spark):
    scores = spark.createDataFrame(
        [(1, "Persistence", .9, 1., 1.), (1, "Ridge", .8, 1., 1.),
         (2, "Persistence", .5, 1., 1.), (2, "Ridge", .6, 1., 1.)],
        "block int, model string, r2 double, rmse double, mae double")
    rows = {r.block: r for r in metrics.select_model(scores).collect()}
    assert not rows[1].served and rows[2].served and rows[2].winner == "Ridge"
    assert rows[2].improvement == pytest.approx(0.1)


def test_ridge_is_the_closed_form(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 3)) * [1, 10, 100] + [0, 5, -20]
    y = x @ [2.0, -0.3, 0.01] + rng.normal(size=400) * 3 + 50
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=["a", "b", "c", "y"]))
    fitted = models.ridge(df, ["a", "b", "c"], alpha=25.0).stages[-1]
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(z.T @ z + 25.0 * np.eye(3), z.T @ (y - y.mean())) / x.std(0)
    np.testing.assert_allclose(fitted.coefficients.toArray(), w, rtol=1e-8)
    assert fitted.intercept == pytest.approx(y.mean() - w @ x.mean(0))


def test_training_selects_and_scores(spark, table):
    result = models.train_block(table, 1, {"Ridge": models.ridge}, delta=True, least_rows=100)
    assert {s["model"] for s in result.scores} == {"Persistence", "Ridge"}
    assert result.winner in ("Persistence", "Ridge")
    if result.model is not None:
        assert result.by_hour and set(result.by_hour) <= set(range(1, 25))
        assert result.summary()["improvement"] > 0
    with pytest.raises(ValueError):
        models.require_rows(table, 10 ** 9)
    assert models.require_rows(table, 10) > 10


def shapley_by_force(predict_subset, d):
    from itertools import combinations
    from math import factorial
    out = np.zeros(d)
    for j in range(d):
        others = [i for i in range(d) if i != j]
        for k in range(d):
            for s in combinations(others, k):
                weight = factorial(k) * factorial(d - k - 1) / factorial(d)
                out[j] += weight * (predict_subset({*s, j}) - predict_subset(set(s)))
    return out


def test_tree_contributions(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 4))
    y = np.where(x[:, 0] > 0, 3 * x[:, 1], -2 * x[:, 2]) + x[:, 3] * x[:, 0]
    df = pd.DataFrame(x, columns=list("abcd"))
    df["y"], df["station_id"], df["ts"] = y, 1, START
    train = spark.createDataFrame(df)
    for fit in (lambda d: models.boosted(d, list("abcd"), rounds=4, depth=4, step=0.5, sample=1.0),
                lambda d: models.forest(d, list("abcd"), trees=5, depth=5, leaf=5, sample=0.8)):
        model = fit(train)
        kind = type(model.stages[-1]).__name__
        trees, weights = explain.tree_arrays(model.stages[-1], str(tmp_path / kind))
        wide = explain.tree_attribution(train, list("abcd"), trees, weights).toPandas()
        predicted = model.transform(train).toPandas()["prediction"]
        total = wide[list("abcd")].sum(axis=1) + wide["base"]
        np.testing.assert_allclose(np.sort(total), np.sort(predicted), rtol=1e-8, atol=1e-8)

    def expected(tree, known, row, node=0):
        at = tree["id"].index(node)
        left, right = tree["leftChild"][at], tree["rightChild"][at]
        if left < 0:
            return tree["prediction"][at]
        if tree["feature"][at] in known:
            go = left if row[tree["feature"][at]] <= tree["threshold"][at] else right
            return expected(tree, known, row, go)
        n = {c: tree["rawCount"][tree["id"].index(c)] for c in (left, right)}
        return sum(n[c] * expected(tree, known, row, c) for c in (left, right)) / sum(n.values())

    parts = explain.tree_contributions(x[:5], trees, weights)
    for i in range(5):
        forced = sum(w * shapley_by_force(lambda s, t=t: expected(t, s, x[i]), 4)
                     for t, w in zip(trees, weights))
        np.testing.assert_allclose(parts[i, :4], forced, rtol=1e-8, atol=1e-8)


def test_linear_parts_add_up(spark, table):
    examples = frame.training_frame(table, 1, 24)
    model = models.ridge(examples)
    rows = forecast.model_input(complete(table).withColumn("hours_ahead", F.lit(12)))
    parts, base = explain.linear_model_parts(model, rows, MODEL_INPUTS)
    each = explain.linear_attribution(rows, MODEL_INPUTS, parts)
    total = each.groupBy("station_id", "ts").agg((F.sum("contribution") + base).alias("total"))
    both = model.transform(rows).join(total, ["station_id", "ts"])
    assert both.filter(F.abs(F.col("prediction") - F.col("total")) > 1e-6).count() == 0


def test_forecast_shape_and_alerts(spark, table):
    ahead = forecast.persistence_forecast(table)
    assert ahead.count() == 144
    first = forecast.latest_complete(table).select("station_id", F.col("ts").alias("now"))
    leads = ahead.join(first, "station_id").filter(
        "unix_timestamp(ts) - unix_timestamp(now) <> hours_ahead * 3600")
    assert leads.count() == 0
    assert forecast.daily_summary(ahead).count() == 6
    worst = forecast.alerts(ahead, 0)
    assert worst.count() == 2 and worst.filter("hours_ahead <> 1").count() == 0


def test_history_cards_and_sparkline(spark, table):
    cards = forecast.history_cards(table).toPandas().set_index(["station_id", "span_hours"])
    one = sorted_pandas(table.filter("station_id = 1"))
    for n in (24, 168, 720):
        tail = one.tail(n)["aqi"]
        assert cards.loc[(1, n), "mean_aqi"] == int(tail.mean())
        assert cards.loc[(1, n), "readings"] == len(tail)
    lines = forecast.sparkline(table, ["pm10"]).filter("station_id = 1").first()
    assert len(lines["values"]) == 48 and min(lines.scaled) == 0.0


def test_response_curve_matches_pandas(spark, table):
    got = explore.decile_response(table, ["humidity"]).toPandas().sort_values("bin")
    df = table.select("humidity", "aqi").dropna().toPandas()
    bins = pd.qcut(df.humidity, 10, duplicates="drop")
    want = df.groupby(bins, observed=True).aqi.agg(["mean", "count"])
    np.testing.assert_allclose(got.mean_aqi, want["mean"])
    assert got.rows.tolist() == want["count"].tolist()


def test_correlations_match_pandas(spark, table):
    names = ["aqi", "pm10", "humidity", "temp_range_24h"]
    got = explore.corr_matrix(table, names).toPandas()
    want = table.select(*names).toPandas().corr()
    for r in got.itertuples():
        assert r.r == pytest.approx(want.loc[r.left_column, r.right_column])


def test_feature_list_is_whole():
    assert len(FEATURES) == 69 and len(MODEL_INPUTS) == 76
