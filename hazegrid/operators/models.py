"""Baselines and models of the index ahead, trained with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.operators import boosting, gram
from hazegrid.operators.chunks import KEY
from hazegrid.operators.frame import chrono_split, training_frame
from hazegrid.operators.metrics import measure, r2_by_hour, swing
from hazegrid.schemas import (FEATURES, HORIZONS, LEAD_FEATURES, MIN_TRAINING_ROWS, MODEL_INPUTS,
                              RANDOM_SEED, SPLIT_RATIO)
from hazegrid.session import discard

BASELINE = "Persistence"


def _assembler(inputs):
    return VectorAssembler(inputCols=list(inputs), outputCol="features")


def ridge(train: DataFrame, inputs=MODEL_INPUTS, alpha: float = 1.0,
          label: str = "y") -> PipelineModel:
    """Ridge regression on standardised inputs, solved from one pass over the data.

    The solver divides its penalty by the label's deviation and works per example, so
    ``alpha`` is brought to that scale.
    """
    n, spread = train.agg(F.count(label), F.stddev_pop(label)).first()
    fitted = LinearRegression(labelCol=label, elasticNetParam=0.0, standardization=True,
                              solver="normal", regParam=alpha * (spread or 0.0) / max(n, 1))
    return Pipeline(stages=[_assembler(inputs), fitted]).fit(train)


def ridge_block(table: DataFrame, day: int, alpha: float = 1.0, *, delta: bool = False,
                embargo_rows: int = 0, target_mode: str = "time", sums: dict | None = None
                ) -> PipelineModel:
    """``ridge`` on the training part of a block, without the expanded frame.

    ``sums`` are those of ``train_sums``, which serve all blocks and both targets.
    """
    sums = sums or train_sums(table, embargo_rows=embargo_rows, target_mode=target_mode)
    known = sums[day, gram.TRAIN, gram.TRAIN]
    return gram.ridge_model(table.sparkSession, known.less("aqi") if delta else known, alpha)


def train_sums(table: DataFrame, *, embargo_rows: int = 0, target_mode: str = "time",
               features=FEATURES, ratio: float = SPLIT_RATIO, blocks: dict = HORIZONS) -> dict:
    """Sums of all blocks by part of the chronological split, from one pass."""
    return gram.block_sums(table, gram.split_part(ratio, embargo_rows), blocks=blocks,
                           inputs=[*features, *LEAD_FEATURES], features=features,
                           target_mode=target_mode)


def forest(train: DataFrame, inputs=MODEL_INPUTS, label: str = "y", trees: int = 100,
           depth: int = 20, leaf: int = 50, sample: float = 0.3) -> PipelineModel:
    """Random forest; every tree sees a share of the examples."""
    fitted = RandomForestRegressor(
        labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf,
        subsamplingRate=sample, featureSubsetStrategy="all", seed=RANDOM_SEED,
        maxMemoryInMB=1024)
    return Pipeline(stages=[_assembler(inputs), fitted]).fit(train)


def boosted(train: DataFrame, inputs=MODEL_INPUTS, label: str = "y", rounds: int = 600,
            depth: int = 8, step: float = 0.05, sample: float = 0.8,
            columns: float = 0.8) -> PipelineModel:
    """Gradient-boosted trees; every tree sees a share of the examples and of the inputs."""
    inputs, settings = list(inputs), {"sample": sample, "columns": columns, "seed": RANDOM_SEED}
    nodes = boosting.boosted_trees(train, inputs, label, rounds=rounds, depth=depth, step=step, **settings)
    named = GBTRegressor(
        labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=sample,
        featureSubsetStrategy=str(columns), seed=RANDOM_SEED)
    fitted = boosting.model_of(nodes, len(inputs), step, named)
    discard(nodes)
    return PipelineModel([_assembler(inputs), fitted])


ALGORITHMS = {"Ridge": ridge, "Random Forest": forest, "Boosted Trees": boosted}


def naive_predictions(examples: DataFrame) -> dict:
    """Column expressions of baselines that need no fitting."""
    return {BASELINE: F.col("aqi"), "3-day mean": F.col("aqi_roll_mean_3d"),
            "Same hour yesterday": F.col("aqi_lag_24h")}


def score_naive(examples: DataFrame, groups=("block",)) -> DataFrame:
    """Scores of the naive baselines on absolute targets ``y``."""
    each = examples.select(*groups, F.col("y").alias("actual"), F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), p.cast("double").alias("predicted"))
        for name, p in naive_predictions(examples).items()])))
    return measure(each.filter("predicted is not null"), [*groups, "model"])


def predict_level(model: PipelineModel, examples: DataFrame, delta: bool) -> DataFrame:
    """Predictions and actuals on the level of the index, whatever the target was."""
    out = model.transform(examples)
    add = F.col("aqi") if delta else F.lit(0.0)
    return out.select(KEY, "ts", "row_nr", "hours_ahead", "aqi",
                      (F.col("y") + add).alias("actual"),
                      (F.col("prediction") + add).alias("predicted"))


def linear_levels(table: DataFrame, fits: dict, *, deltas=(), features=FEATURES,
                  target_mode: str = "time") -> DataFrame:
    """``predict_level`` of each block's linear model (by day), with ``row_count`` and ``block``.

    A linear prediction is a sum over powers of the lead time whose factors belong to the source
    row. They are settled before the examples' shuffle, which then moves no inputs, and all
    blocks share it. ``deltas`` are the days whose model predicts a change.
    """
    factors, predicted = {}, F.lit(None).cast("double")
    for day, model in fits.items():
        names, fitted = model.stages[0].getInputCols(), model.stages[-1]
        by_power: dict = {}
        for name, weight in zip(names, fitted.coefficients, strict=True):
            column, power = gram.parts_of(name)
            value = F.lit(1.0) if column is None else F.col(column).cast("double")
            by_power.setdefault(power, []).append(value * F.lit(float(weight)))
        each = F.lit(float(fitted.intercept)) + (F.col("aqi") if day in deltas else F.lit(0.0))
        for i, (power, terms) in enumerate(sorted(by_power.items())):
            factors[f"_{day}_{i}"] = sum(terms[1:], terms[0])
            each = each + F.col(f"_{day}_{i}") * F.pow(F.col("hours_ahead").cast("double"), F.lit(power))
        first, last = HORIZONS[day]
        predicted = F.when(F.col("hours_ahead").between(first, last), each).otherwise(predicted)
    reach = [HORIZONS[day] for day in fits]
    rows = training_frame(table.withColumns(factors), min(a for a, _ in reach), max(b for _, b in reach),
                          features=features, target_mode=target_mode, carry=list(factors))
    day_of = F.lit(None).cast("int")
    for day in fits:
        day_of = F.when(F.col("hours_ahead").between(*HORIZONS[day]), F.lit(day)).otherwise(day_of)
    return rows.select(day_of.alias("block"), KEY, "ts", "row_nr", "row_count", "hours_ahead", "aqi",
                       F.col("y").alias("actual"), predicted.alias("predicted")).filter("block is not null")


@dataclass
class BlockResult:
    """Outcome of training one forecast block; ``model`` is None when refused."""

    day: int
    winner: str
    model: PipelineModel | None
    delta: bool
    scores: list = field(default_factory=list)
    by_hour: dict = field(default_factory=dict)
    predicted_swing: float | None = None
    actual_swing: float | None = None

    def score(self, name: str) -> dict:
        return next(s for s in self.scores if s["model"] == name)

    def summary(self) -> dict:
        best, base = self.score(self.winner), self.score(BASELINE)
        return {"r2": best["r2"], "rmse": best["rmse"], "mae": best["mae"],
                "baseline_r2": base["r2"], "improvement": best["r2"] - base["r2"],
                "prediction_spread": best["prediction_spread"]}


def require_rows(table: DataFrame, least: int = MIN_TRAINING_ROWS) -> int:
    """Refuse to train on a table that is too small to be the real one."""
    n = table.count()
    if n < least:
        raise ValueError(f"only {n} rows, refusing to train on fewer than {least}")
    return n


def train_block(table: DataFrame, day: int, algorithms: dict, *, delta: bool = False,
                split_mode: str = "row", target_mode: str = "time", features=FEATURES,
                embargo_rows: int = 0, least_rows: int = MIN_TRAINING_ROWS) -> BlockResult:
    """Fit the algorithms on one block, score them, and keep the best unless the
    baseline wins. A table of fewer than ``least_rows`` rows is refused."""
    require_rows(table, least_rows)
    first, last = HORIZONS[day]
    examples = chrono_split(
        training_frame(table, first, last, delta=delta, target_mode=target_mode,
                       features=features), mode=split_mode, embargo_rows=embargo_rows)
    train = examples.filter("split = 'train'")
    test = examples.filter("split = 'test'")
    actual = (F.col("y") + F.col("aqi")) if delta else F.col("y")
    scored = {BASELINE: test.select(KEY, "ts", "row_nr", "hours_ahead", actual.alias("actual"),
                                    F.col("aqi").alias("predicted"))}
    models = {}
    for name, fit in algorithms.items():
        models[name] = fit(train)
        scored[name] = predict_level(models[name], test, delta)
    scores = [{"model": name, **measure(df, []).first().asDict()}
              for name, df in scored.items()]
    winner = max(scores, key=lambda s: (s["r2"], s["model"]))["model"]
    result = BlockResult(day, winner, models.get(winner), delta, scores)
    if result.model is not None:
        result.by_hour = {r["hours_ahead"]: r["r2"]
                          for r in r2_by_hour(scored[winner]).collect()}
        moves = swing(scored[winner], []).first()
        if moves is not None:
            result.predicted_swing = moves["predicted_swing"]
            result.actual_swing = moves["actual_swing"]
    return result
