"""Ridge from sums against the expanded frame, folds against fits of their own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazegrid.catalog.queries import tables_of
from hazegrid.operators import backtest, frame, gram, models
from hazegrid.schemas import FEATURES, HORIZONS, MODEL_INPUTS


@pytest.fixture(scope="module")
def table(spark, data):
    t = tables_of(spark, data)
    return t.features


@pytest.fixture(scope="module")
def expanded(table):
    """All examples of all blocks as one frame."""
    parts = []
    for day, (first, last) in HORIZONS.items():
        rows = frame.chrono_split(frame.training_frame(table, first, last))
        df = rows.select("station_id", "ts", "row_nr", "split", "y", *MODEL_INPUTS).toPandas()
        df["block"] = day
        parts.append(df)
    import pandas as pd
    return pd.concat(parts, ignore_index=True)


def matrix(df):
    z = np.column_stack([np.ones(len(df)), df[MODEL_INPUTS].to_numpy(float), df["y"].to_numpy(float)])
    return z.T @ z


def closed_form(df, alpha=1.0, delta=False):
    x, y = df[MODEL_INPUTS].to_numpy(float), df["y"].to_numpy(float)
    y = y - df["aqi"].to_numpy(float) if delta else y
    mean, spread = x.mean(axis=0), x.std(axis=0)
    moving = spread > 1e-9
    z = (x[:, moving] - mean[moving]) / spread[moving]
    w = np.zeros(x.shape[1])
    w[moving] = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean())) / spread[moving]
    return y.mean() - w @ mean, w


def test_sums_equal_the_expanded_frame(table, expanded):
    sums = models.train_sums(table)
    for (block, part, _), m in sums.items():
        mine = expanded[(expanded.block == block) & (expanded.split == ("train", "test")[part])]
        want = matrix(mine)
        assert m.n == len(mine)
        assert np.allclose(m.matrix, want, rtol=1e-9, atol=1e-6)


def test_row_targets_and_embargo(table):
    sums = models.train_sums(table, target_mode="row", embargo_rows=72, blocks={1: (1, 24)})
    rows = frame.chrono_split(frame.training_frame(table, 1, 24, target_mode="row"), embargo_rows=72)
    found = {r["split"]: r for r in rows.groupBy("split").agg(
        F.count("y").alias("n"), F.sum("y").alias("y"), F.sum(F.col("y") * F.col("aqi_x_hours")).alias("xy")
    ).collect()}
    at = 1 + MODEL_INPUTS.index("aqi_x_hours")
    for part, name in ((gram.TRAIN, "train"), (gram.TEST, "test"), (gram.EMBARGO, "embargo")):
        m = sums[1, part, part].matrix
        assert np.allclose([m[0, 0], m[0, -1], m[at, -1]], [found[name][c] for c in ("n", "y", "xy")])


@pytest.mark.parametrize("delta", [False, True])
def test_model_from_sums_equals_the_fit_on_examples(spark, table, expanded, delta):
    sums = models.train_sums(table)
    for day in HORIZONS:
        train = expanded[(expanded.block == day) & (expanded.split == "train")]
        intercept, weights = closed_form(train, delta=delta)
        x = expanded[MODEL_INPUTS].to_numpy(float)[::97]
        want = intercept + x @ weights
        model = models.ridge_block(table, day, delta=delta, sums=sums).stages[-1]
        got = model.intercept + x @ model.coefficients.toArray()
        assert np.allclose(got, want, rtol=1e-5, atol=1e-3)
        known = sums[day, gram.TRAIN, gram.TRAIN]
        a, w = gram.solved(known.less("aqi") if delta else known)
        assert np.allclose(a + x @ w, want, rtol=1e-5, atol=1e-3)


def test_saved_pipeline_predicts(spark, table, tmp_path):
    model = models.ridge_block(table, 1)
    rows = frame.training_frame(table, 1, 24).limit(20)
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    from pyspark.ml import PipelineModel
    again = PipelineModel.load(path)
    one = [r["prediction"] for r in model.transform(rows).orderBy("station_id", "ts", "hours_ahead").collect()]
    two = [r["prediction"] for r in again.transform(rows).orderBy("station_id", "ts", "hours_ahead").collect()]
    assert one == two and len(one) == 20


def test_folds_equal_fits_of_their_own(table, expanded):
    scores = {(r["block"], str(r["origin"]), r["model"]): r
              for r in backtest.rolling_origin(table, least=200).collect()}
    assert scores
    hours = expanded["hours_ahead"].to_numpy().astype(int)
    source = expanded["ts"].dt.to_period("M").dt.to_timestamp()
    target = (expanded["ts"] + np.array(hours, "timedelta64[h]")).dt.to_period("M").dt.to_timestamp()
    for block, origin in sorted({k[:2] for k in scores}):
        train = expanded[(expanded.block == block) & (target < origin)]
        test = expanded[(expanded.block == block) & (source == origin)]
        y = test["y"].to_numpy(float)
        spread = ((y - y.mean()) ** 2).sum()
        x = test[MODEL_INPUTS].to_numpy(float)
        guesses = {"Persistence": test["aqi"].to_numpy(float)}
        for name, delta in (("Ridge", False), ("Ridge (delta)", True)):
            a, w = closed_form(train, delta=delta)
            guesses[name] = a + x @ w + (test["aqi"].to_numpy(float) if delta else 0.0)
        for name, p in guesses.items():
            got = scores[block, origin, name]
            assert got["examples"] == len(test) and got["trained_on"] == len(train)
            assert np.isclose(got["rmse"], np.sqrt(((p - y) ** 2).mean()), rtol=1e-3)
            assert np.isclose(got["r2"], 1 - ((p - y) ** 2).sum() / spread, atol=2e-3)


def test_winner_and_refusal(spark):
    rows = [(1, "2021-01-01", "Persistence", 9, 5, 2.0, 0.5), (1, "2021-01-01", "Ridge", 9, 5, 1.0, 0.6),
            (1, "2021-02-01", "Persistence", 9, 5, 2.0, 0.7), (1, "2021-02-01", "Ridge", 9, 5, 1.0, 0.65),
            (2, "2021-01-01", "Persistence", 9, 5, 2.0, 0.5), (2, "2021-01-01", "Ridge", 9, 5, 3.0, None)]
    scores = spark.createDataFrame(rows, backtest.SCORES.replace("date", "string")).withColumn(
        "origin", F.to_date("origin"))
    got = {r["block"]: r for r in backtest.winners(scores).collect()}
    assert got[1]["winner"] == "Ridge" and got[1]["served"] and got[1]["won"] == 1
    assert got[2]["winner"] == "Persistence" and not got[2]["served"]


def test_rows_without_features_give_targets_only(spark, table):
    holes = table.withColumn("pm2_5", F.when(F.hour("ts") % 2 == 0, F.col("pm2_5")))
    sums = models.train_sums(holes, blocks={1: (1, 24)})
    rows = frame.chrono_split(frame.training_frame(holes, 1, 24)).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in rows} == {
        ("train", "test")[p]: int(m.n) for (_, p, _), m in sums.items()}
    assert len(FEATURES) + 7 == len(MODEL_INPUTS)
    empty = models.train_sums(table.filter("false"))
    assert empty == {}


def test_levels_of_linear_models_equal_the_expanded_frame(table):
    """Predictions from per-row factors, changes and levels side by side, without shuffled inputs."""
    sums = models.train_sums(table)
    fits = {day: models.ridge_block(table, day, delta=day == 1, sums=sums) for day in HORIZONS}
    levels = models.linear_levels(table, fits, deltas=[1])
    plan = levels._jdf.queryExecution().optimizedPlan().toString()
    assert "pressure" not in plan[:plan.index("RepartitionByExpression")]
    keys = ["station_id", "ts", "row_nr", "hours_ahead"]
    for day, (first, last) in HORIZONS.items():
        rows = frame.training_frame(table, first, last, delta=day == 1)
        want = models.predict_level(fits[day], rows, day == 1).toPandas()
        got = levels.filter(F.col("block") == day).toPandas()
        both = want.merge(got, on=keys)
        assert len(both) == len(want) == len(got)
        assert np.allclose(both["actual_x"], both["actual_y"])
        assert np.allclose(both["predicted_x"], both["predicted_y"], rtol=1e-9, atol=1e-8)


def test_error_sums_equal_the_expanded_frame(table, expanded):
    rng = np.random.default_rng(4)
    fits = {day: (float(day), rng.normal(size=len(MODEL_INPUTS)) / 100) for day in HORIZONS}
    found = gram.error_sums(table, gram.split_part(0.8), fits)
    assert len(found) == 6
    for (day, part, _), sums in found.items():
        mine = expanded[(expanded.block == day) & (expanded.split == ("train", "test")[part])]
        x = np.column_stack([np.ones(len(mine)), mine[MODEL_INPUTS].to_numpy(float)])
        error = x @ np.r_[fits[day]] - mine["y"].to_numpy(float)
        assert np.allclose(sums, x.T @ error, rtol=1e-9, atol=1e-6)


def test_rows_are_shuffled_once_however_many_parts_shuffles_have(spark, table):
    names = {"spark.sql.shuffle.partitions": "40", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        rows = frame.training_frame(table, 1, 24)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(station_id" in line
             and ", chunk#" in line]
    # the rows, and the small table of their chunks
    assert sum("REPARTITION_BY_NUM" in line for line in dealt) == 1
    assert sum("ENSURE_REQUIREMENTS" in line for line in dealt) == 1
