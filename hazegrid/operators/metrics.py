"""Scores of predictions against what came later."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.functions.index import clip
from hazegrid.operators.chunks import KEY
from hazegrid.operators.quantiles import exact_quantiles
from hazegrid.schemas import PREDICTION_RANGE


def _scores(actual, predicted) -> dict:
    error = predicted - actual
    n = F.count(error).cast("double")
    squares = F.sum(error * error)
    spread = F.sum(actual * actual) - F.sum(actual) * F.sum(actual) / n
    return {"examples": F.count(error), "rmse": F.sqrt(squares / n),
            "mae": F.sum(F.abs(error)) / n, "r2": F.lit(1.0) - squares / spread}


def measure(df: DataFrame, groups, *, actual: str = "actual",
            predicted: str = "predicted") -> DataFrame:
    """RMSE, MAE and R2 after clipping predictions, and the spread of the raw ones."""
    scores = _scores(F.col(actual), clip(predicted, PREDICTION_RANGE))
    return df.groupBy(*groups).agg(
        *[c.alias(n) for n, c in scores.items()],
        F.stddev_pop(predicted).alias("prediction_spread"))


def r2_by_hour(df: DataFrame, groups=(), *, actual: str = "actual",
               predicted: str = "predicted", least: int = 30) -> DataFrame:
    """R2 per hour ahead with more than ``least`` examples, predictions not clipped."""
    scores = _scores(F.col(actual), F.col(predicted))
    return (df.groupBy(*groups, "hours_ahead")
            .agg(scores["examples"].alias("examples"), scores["r2"].alias("r2"))
            .filter(F.col("examples") > least))


def swing(df: DataFrame, groups, *, actual: str = "actual",
          predicted: str = "predicted") -> DataFrame:
    """Median over source rows of how far a block's values move."""
    per_row = df.groupBy(*groups, KEY, "row_nr").agg(
        (F.max(predicted) - F.min(predicted)).alias("p_move"),
        (F.max(actual) - F.min(actual)).alias("a_move"))
    groups = list(groups)
    moves = per_row.select(*groups, F.inline(F.array(*[
        F.struct(F.lit(side).alias("side"), F.col(move).alias("move"))
        for side, move in (("predicted", "p_move"), ("actual", "a_move"))])))
    medians = exact_quantiles(moves, [*groups, "side"], "move", [0.5])
    out = medians.groupBy(*groups) if groups else medians.groupBy()
    return out.agg(*[F.max(F.when(F.col("side") == side, F.col("quantile"))).alias(f"{side}_swing")
                     for side in ("predicted", "actual")])


def rank_models(scores: DataFrame, group: str = "block") -> DataFrame:
    """Models of each group by R2, best first (ties by name)."""
    order = Window.partitionBy(group).orderBy(F.desc("r2"), "model")
    return scores.withColumn("rank", F.row_number().over(order))


def select_model(scores: DataFrame, group: str = "block",
                 baseline: str = "Persistence") -> DataFrame:
    """The winner per group, its gain on the baseline, and whether it may be served.

    ``scores`` holds one row per model and group. A group is refused when the baseline
    itself wins.
    """
    ranked = rank_models(scores, group)
    best = ranked.groupBy(group).agg(
        F.max(F.when(F.col("rank") == 1, F.col("model"))).alias("winner"),
        *[F.max(F.when(F.col("rank") == 1, F.col(m))).alias(m) for m in ("r2", "rmse", "mae")],
        F.max(F.when(F.col("model") == baseline, F.col("r2"))).alias("baseline_r2"))
    return best.select("*", (F.col("r2") - F.col("baseline_r2")).alias("improvement"),
                       (F.col("winner") != baseline).alias("served"))


def compare_models(absolute: DataFrame, delta: DataFrame, group: str = "block") -> DataFrame:
    """Winners of the absolute and the delta models side by side, better one named."""
    a = absolute.select(group, F.col("winner").alias("absolute_winner"),
                        F.col("r2").alias("absolute_r2"), F.col("rmse").alias("absolute_rmse"))
    d = delta.select(group, F.col("winner").alias("delta_winner"),
                     F.col("r2").alias("delta_r2"), F.col("rmse").alias("delta_rmse"))
    return a.join(d, group, "full").withColumn(
        "better", F.when(F.col("delta_r2") > F.col("absolute_r2"), "delta").otherwise("absolute"))
