"""Least squares without the expanded frame: sums that say all about a block's examples.

Every model input is a column of the source row times 1, the lead time or its root. So the
cross products of a row's examples are its own products times sums over its present leads, and
a block's normal equations follow from one row per hour. Chunks of stations give sums
that add up: over stations, over splits, over months. A fit for any set of months is a sum of
small matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazegrid.functions.features import epoch_hour
from hazegrid.operators.chunks import (CHUNK_HOURS, KEY, add_halo, chunk_window, positions, spread,
                                       with_positions)
from hazegrid.schemas import FEATURES, HORIZONS, LEAD_FEATURES, MODEL_INPUTS

#: Powers of the lead time that inputs are multiplied with.
_ONE, _HOURS, _ROOT = 0.0, 1.0, 0.5


def parts_of(name: str) -> tuple[str | None, float]:
    """A model input as (source column or None, power of the lead time)."""
    if name == "hours_ahead":
        return None, _HOURS
    if name == "sqrt_hours_ahead":
        return None, _ROOT
    if name.endswith("_x_hours") and name in LEAD_FEATURES:
        return name.removesuffix("_x_hours"), _HOURS
    return name, _ONE


@dataclass
class Moments:
    """Sums of products of (1, inputs, target) over a set of examples."""

    inputs: tuple[str, ...]
    matrix: np.ndarray

    @classmethod
    def unpacked(cls, inputs, packed) -> Moments:
        size = len(inputs) + 2
        matrix = np.zeros((size, size))
        matrix[np.triu_indices(size)] = packed
        return cls(tuple(inputs), matrix + np.triu(matrix, 1).T)

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.inputs, self.matrix + other.matrix)

    @property
    def n(self) -> float:
        return float(self.matrix[0, 0])

    @property
    def means(self) -> np.ndarray:
        return self.matrix[0, 1:] / self.n

    @property
    def covariance(self) -> np.ndarray:
        """Of inputs and target; a column that never moves has none at all."""
        means = self.means
        out = self.matrix[1:, 1:] / self.n - np.outer(means, means)
        still = np.diag(out) <= 1e-12 * np.maximum(np.diag(self.matrix)[1:] / self.n, 1e-300)
        out[still] = 0.0
        out[:, still] = 0.0
        return out

    def less(self, name: str) -> Moments:
        """The same examples with an input taken off the target."""
        change = np.eye(len(self.matrix))
        change[-1, 1 + self.inputs.index(name)] = -1.0
        return Moments(self.inputs, change @ self.matrix @ change.T)

    def errors(self, intercept: float, weights: np.ndarray) -> dict:
        """Scores of a linear prediction, not clipped: examples, rmse, r2."""
        direction = np.r_[intercept, weights, -1.0]
        squares = max(0.0, float(direction @ self.matrix @ direction))
        spread = float(self.matrix[-1, -1] - self.matrix[0, -1] ** 2 / self.n)
        return {"examples": int(self.n), "rmse": (squares / self.n) ** 0.5,
                "r2": 1.0 - squares / spread if spread > 0 else None}


def solved(moments: Moments, alpha: float = 1.0) -> tuple[float, np.ndarray]:
    """(intercept, weights) of ridge on standardised inputs, in the inputs' own units."""
    cov, means = moments.covariance, moments.means
    spread = np.sqrt(np.diag(cov))[:-1]
    moving = spread > 0
    weights = np.zeros(len(spread))
    if moving.any():
        s = spread[moving]
        inner = cov[:-1, :-1][np.ix_(moving, moving)] / np.outer(s, s)
        inner += alpha / moments.n * np.eye(len(s))
        weights[moving] = np.linalg.solve(inner, cov[:-1, -1][moving] / s) / s
    return float(means[-1] - weights @ means[:-1]), weights


def ridge_model(spark: SparkSession, moments: Moments, alpha: float = 1.0) -> PipelineModel:
    """The ridge of ``models.ridge`` as a Spark ML pipeline, from sums alone.

    The solver sees its data only through weighted means and products. So it is given a few
    weighted points with the same ones: the mean plus and minus each axis of the covariance.
    """
    cov, means = moments.covariance, moments.means
    scale = np.sqrt(np.diag(cov))
    unit = np.where(scale > 0, scale, 1.0)
    values, axes = np.linalg.eigh(cov / np.outer(unit, unit))
    steps = (axes * np.sqrt(np.clip(values, 0.0, None) * len(values))).T * scale
    points = np.concatenate([means + steps, means - steps])
    weight = moments.n / len(points)
    rows = [(Vectors.dense(p[:-1]), float(p[-1]), weight) for p in points]
    data = spark.createDataFrame(rows, ["features", "y", "weight"])
    fitted = LinearRegression(
        labelCol="y", weightCol="weight", elasticNetParam=0.0, standardization=True, solver="normal",
        regParam=alpha * float(scale[-1]) / moments.n).fit(data)
    assembler = VectorAssembler(inputCols=list(moments.inputs), outputCol="features")
    # both stages are transformers already, so nothing is fitted here
    return Pipeline(stages=[assembler, fitted]).fit(data.limit(0))


def _by_power(inputs) -> dict:
    """For each power of the lead time: places of its inputs among (1, inputs) and their columns."""
    places = [parts_of(name) for name in inputs]
    columns = {p: [(k + 1, c) for k, (c, q) in enumerate(places) if q == p]
               for p in sorted({p for _, p in places} | {_ONE})}
    columns[_ONE] = [(0, None), *columns[_ONE]]
    return {p: (np.array([k for k, _ in each]), [c for _, c in each]) for p, each in columns.items()}


def _products(inputs: tuple[str, ...]):
    """A function from a chunk's rows and leads to packed sums of products."""
    powers = _by_power(inputs)
    total = len(inputs) + 2
    upper = np.triu_indices(total)

    def sums(block: int, x: dict, leads: np.ndarray, present: np.ndarray, later: np.ndarray) -> np.ndarray:
        out = np.zeros((total, total))
        y = np.where(present, later, 0.0)
        sides = {p: (rows, np.column_stack([x[c] for c in names])) for p, (rows, names) in powers.items()}
        for p, q in product(powers, powers):
            weight = present @ (leads ** (p + q))
            (rows, a), (cols, b) = sides[p], sides[q]
            out[np.ix_(rows, cols)] = a.T @ (b * weight[:, None])
        for p in powers:
            rows, a = sides[p]
            out[rows, -1] = a.T @ (y @ (leads ** p))
        out[-1, -1] = (y * y).sum()
        return out[upper]

    return sums


def _error_products(inputs: tuple[str, ...], fits: dict[int, tuple[float, np.ndarray]]):
    """A function from a chunk's rows and leads to sums of a linear fit's error times (1, inputs)."""
    powers = _by_power(inputs)

    def sums(block: int, x: dict, leads: np.ndarray, present: np.ndarray, later: np.ndarray) -> np.ndarray:
        weights = np.r_[fits[block][0], fits[block][1]]
        sides = {p: (rows, np.column_stack([x[c] for c in names])) for p, (rows, names) in powers.items()}
        predicted = sum(np.outer(a @ weights[rows], leads ** p) for p, (rows, a) in sides.items())
        error = np.where(present, predicted - later, 0.0)
        out = np.zeros(len(weights))
        for p, (rows, a) in sides.items():
            out[rows] = a.T @ (error @ (leads ** p))
        return out

    return sums


def _chunk_work(sums, features: tuple[str, ...], blocks: dict, size: int, by_month: bool):
    """A function from one chunk of a station to its packed sums."""
    def work(table: pa.Table) -> pa.Table:
        at = table["_at"].to_numpy()
        chunk = table["chunk"][0].as_py()
        offset = at - chunk * size
        furthest = max(last for _, last in blocks.values())
        dense = np.full(size + furthest + 1, np.nan)
        dense[offset] = table["aqi"].to_numpy()
        raw = {c: table[c].to_numpy().astype(float) for c in features}
        own = offset < size
        for c in features:
            own &= ~np.isnan(raw[c])
        part = table["_part"].to_numpy()
        found = []
        for value in np.unique(part[own]):
            rows = np.flatnonzero(own & (part == value))
            x = {c: v[rows] for c, v in raw.items()} | {None: np.ones(len(rows))}
            for block, (first, last) in blocks.items():
                leads = np.arange(first, last + 1)
                later = dense[offset[rows][:, None] + leads]
                known = ~np.isnan(later)
                crossed = np.zeros_like(known)
                if by_month:
                    hours = (at[rows][:, None] + leads).astype("datetime64[h]")
                    crossed = hours.astype("datetime64[M]").astype(int) != value
                for target, mask in ((0, known & ~crossed), (1, known & crossed)):
                    if mask.any():
                        found.append((block, int(value), int(value) + target if by_month else
                                      int(value), sums(block, x, leads.astype(float), mask, later)))
        return pa.table({
            "block": pa.array([f[0] for f in found], pa.int32()),
            "part": pa.array([f[1] for f in found], pa.int64()),
            "target_part": pa.array([f[2] for f in found], pa.int64()),
            "sums": pa.array([f[3] for f in found], pa.list_(pa.float64()))})

    return work


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key of a task's rows, so that a task sends little, however many chunks it has."""
    held: dict[tuple, np.ndarray] = {}
    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in ("block", "part", "target_part")], strict=True)
        for key, packed in zip(keys, batch.column("sums"), strict=True):
            values = packed.values.to_numpy()
            held[key] = held[key] + values if key in held else values.copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in held], pa.int32()), pa.array([k[1] for k in held], pa.int64()),
         pa.array([k[2] for k in held], pa.int64()),
         pa.array(list(held.values()), pa.list_(pa.float64()))],
        ["block", "part", "target_part", "sums"])


def block_sums(table: DataFrame, part: Column, *, blocks: dict = HORIZONS, inputs=MODEL_INPUTS,
               features=FEATURES, target_mode: str = "time", by_month: bool = False,
               size: int = CHUNK_HOURS) -> dict[tuple[int, int, int], Moments]:
    """Sums of every block's examples by (block, part, target part), from one shuffle.

    ``part`` is a whole number per source row (of the table with ``row_nr`` and ``row_count``).
    With ``by_month`` it is the month since 1970 and the target's month is kept apart, so that
    examples whose target was not known yet can be left out. A station has one row per hour.
    Rows lacking a feature give no examples, but their index is a target. The driver gets one
    matrix per block and part.
    """
    found = _summed(table, part, _products(tuple(inputs)), blocks, features, target_mode, by_month, size)
    return {key: Moments.unpacked(inputs, packed) for key, packed in found.items()}


def error_sums(table: DataFrame, part: Column, fits: dict[int, tuple[float, np.ndarray]], *,
               blocks: dict = HORIZONS, inputs=MODEL_INPUTS, features=FEATURES,
               target_mode: str = "time", size: int = CHUNK_HOURS) -> dict[tuple[int, int, int], np.ndarray]:
    """Sums of (1, inputs) times the error of each block's linear fit, over all its examples.

    ``fits`` holds an intercept and weights per block; every example is predicted. Keys are those
    of ``block_sums``.
    """
    found = _summed(table, part, _error_products(tuple(inputs), fits), blocks, features, target_mode,
                    False, size)
    return {key: np.array(packed) for key, packed in found.items()}


def _summed(table: DataFrame, part: Column, sums, blocks: dict, features, target_mode: str,
            by_month: bool, size: int) -> dict[tuple[int, int, int], list]:
    schema = "block int, part long, target_part long, sums array<double>"
    columns = [F.col(c).cast("double").alias(c) for c in dict.fromkeys(["aqi", *features])]
    furthest = max(last for _, last in blocks.values())
    by_row, tasks = target_mode == "row", table.count()
    if by_row or by_month:
        rows = with_positions(table, size=size) if by_row else table
        at = F.col("row_nr") if by_row else epoch_hour("ts")
        rows = rows.select(KEY, at.cast("long").alias("_at"), part.cast("long").alias("_part"), *columns)
        frames = spread(add_halo(rows, ahead=furthest, size=size, hour="_at"), tasks, KEY, "chunk")
    else:
        # numbered where the chunks lie already: the wide rows are shuffled once
        rows = table.select(KEY, epoch_hour("ts").cast("long").alias("_at"), *columns)
        frames = spread(add_halo(rows, ahead=furthest, size=size, hour="_at"), tasks, KEY, "chunk", joined=True)
        frames = frames.join(positions(table, size), [KEY, "chunk"], "left").withColumn(
            "row_nr", F.col("before") + F.row_number().over(chunk_window("_at")) - 1)
        frames = frames.withColumn("_part", part.cast("long")).drop("before", "row_nr", "row_count")
    work = _chunk_work(sums, tuple(features), dict(blocks), size, by_month)
    each = frames.groupBy(KEY, "chunk").applyInArrow(work, schema).mapInArrow(_added_up, schema)
    added = each.select("block", "part", "target_part", F.posexplode("sums")).groupBy(
        "block", "part", "target_part", "pos").agg(F.sum("col").alias("value"))
    whole = added.groupBy("block", "part", "target_part").agg(
        F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("v"))
    return {(r["block"], r["part"], r["target_part"]): r["v"]
            for r in whole.withColumn("v", F.col("v.value")).collect()}


#: Parts of a chronological split.
TRAIN, TEST, EMBARGO = 0, 1, 2


def split_part(ratio: float, embargo_rows: int = 0) -> Column:
    """Part of a numbered table row: the split of ``chrono_split(mode="row")`` as a number."""
    border = F.floor(F.col("row_count") * F.lit(ratio))
    return (F.when(F.col("row_nr") >= border, TEST)
            .when(F.col("row_nr") >= border - embargo_rows, EMBARGO).otherwise(TRAIN))


def month_part(ts: str = "ts") -> Column:
    return (F.year(ts) - 1970) * 12 + F.month(ts) - 1


def month_name(part: int) -> str:
    return f"{1970 + part // 12}-{part % 12 + 1:02}-01"


cloudpickle.register_pickle_by_value(__import__("sys").modules[__name__])
