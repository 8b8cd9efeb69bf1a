"""Boosted trees: the fit itself, and that the queries ask for all of it."""

import inspect
from threading import Lock

import numpy as np
import pandas as pd
import pytest

from hazegrid.catalog import learned
from hazegrid.catalog.queries import Tables
from hazegrid.operators import boosting, models
from hazegrid.plans.features import build_features
from series import readings, to_spark


def examples(rows=400, seed=5):
    rng = np.random.default_rng(seed)
    df = pd.DataFrame({c: rng.integers(0, 20, rows) / 4.0 for c in "abc"})
    df["y"] = np.where(df.a > 2, 3 * df.b, df.c) + rng.normal(size=rows)
    return df


def greedy(x, y, depth):
    """Predictions of a tree by trying every cut."""
    found = None
    for j in range(x.shape[1]) if depth else ():
        for cut in np.unique(x[:, j])[:-1]:
            left = x[:, j] <= cut
            gain = left.sum() * y[left].mean() ** 2 + (~left).sum() * y[~left].mean() ** 2
            if found is None or gain > found[0] + 1e-9:
                found = gain, left
    if found is None:
        return np.full(len(y), y.mean())
    out = np.empty(len(y))
    for side in (found[1], ~found[1]):
        out[side] = greedy(x[side], y[side], depth - 1)
    return out


@pytest.mark.parametrize("most", [100_000, 100])
def test_boosted_trees_equal_greedy_ones(spark, monkeypatch, most):
    monkeypatch.setattr(boosting, "TASK_EXAMPLES", most)  # one task, or four that meet
    monkeypatch.setattr(boosting, "PACK_ROWS", 16)
    df = examples()
    model = models.boosted(spark.createDataFrame(df).repartition(3), list("abc"), rounds=3, depth=3, step=0.5,
                           sample=1.0, columns=1.0)
    got = model.transform(spark.createDataFrame(df)).toPandas()["prediction"].to_numpy()
    x, y = df[list("abc")].to_numpy(), df["y"].to_numpy()
    expected = greedy(x, y, 3)
    for _ in range(2):
        expected = expected + 0.5 * greedy(x, 2 * (y - expected), 3)
    np.testing.assert_allclose(got, expected, rtol=1e-9, atol=1e-9)
    fitted = model.stages[-1]
    assert fitted.getNumTrees == 3 and list(fitted.treeWeights) == [1.0, 0.5, 0.5]


def test_summaries_keep_the_quantiles():
    values = np.random.default_rng(1).normal(size=200_000)
    parts = [boosting._spots(v, None) for v in np.split(values, 16)]
    while len(parts) > 1:
        parts = [boosting._joined(parts[i:i + 2]) for i in range(0, len(parts), 2)]
    cuts = boosting._cuts(*parts[0], 32)
    shares = np.searchsorted(np.sort(values), cuts) / len(values)
    np.testing.assert_allclose(shares, np.arange(1, 32) / 32, atol=0.006)


def test_missing_inputs_are_refused(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 2.0)], "a double, y double")
    with pytest.raises(Exception, match="missing values in a"):
        models.boosted(df, ["a"], rounds=1, depth=1)


@pytest.mark.parametrize("name", ["boosted_delta_scores", "trained_blocks"])
def test_queries_boost_at_full_size(spark, monkeypatch, name):
    t = Tables(spark, "nowhere")
    t.__dict__["features"] = build_features(to_spark(spark, readings(900, known=1.0, present=1.0)))
    asked, held, lock, real = [], [], Lock(), models.boosted

    def small(*args, **options):
        call = inspect.signature(real).bind(*args, **options)
        call.apply_defaults()
        with lock:
            asked.append(tuple(call.arguments[c] for c in ("rounds", "depth", "step", "sample", "columns")))
            if not held:
                held.append(real(args[0], rounds=1, depth=1))
        return held[0]

    monkeypatch.setattr(models, "boosted", small)
    rows = getattr(learned, name)(t).collect()
    assert {r["block"] for r in rows} == {1, 2, 3}
    assert asked == [(600, 8, 0.05, 0.8, 0.8)] * len(rows)
