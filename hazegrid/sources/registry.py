"""Fitted models and their manifest: feature order, scores, type, block, version."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("version", T.LongType(), False),
    T.StructField("type", T.StringType()),
    T.StructField("algorithm", T.StringType()),
    T.StructField("first_hour", T.IntegerType()),
    T.StructField("last_hour", T.IntegerType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("r2", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("baseline_r2", T.DoubleType()),
    T.StructField("improvement", T.DoubleType()),
    T.StructField("path", T.StringType()),
])


def manifest(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/manifest"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def latest_versions(df: DataFrame) -> DataFrame:
    """The newest version of each model."""
    rest = [c for c in df.columns if c not in ("model", "version")]
    newest = df.groupBy("model").agg(F.max_by(F.struct("version", *rest), "version").alias("m"))
    return newest.select("model", "m.*")


def list_versions(df: DataFrame) -> DataFrame:
    """All versions of each model with the number of newer ones."""
    order = Window.partitionBy("model").orderBy(F.desc("version"))
    return df.withColumn("newer", F.row_number().over(order) - 1)


def register(model: PipelineModel, root: str, *, name: str, type: str, algorithm: str,
             block: tuple, features: list, scores: dict) -> int:
    """Save a fitted pipeline as the next version and add its manifest row."""
    if type not in ("absolute", "delta"):
        raise ValueError(type)
    spark = SparkSession.active()
    known = (manifest(spark, root).filter(F.col("model") == name)
             .agg(F.max("version")).first()[0])
    version = (known or 0) + 1
    path = f"{root.rstrip('/')}/{name}/version={version}"
    model.write().save(path)
    gain = scores["r2"] - scores["baseline_r2"]
    row = [(name, version, type, algorithm, block[0], block[1], list(features),
            float(scores["r2"]), float(scores["rmse"]), float(scores["mae"]),
            float(scores["baseline_r2"]), float(gain), path)]
    (spark.createDataFrame(row, MANIFEST).coalesce(1)
     .write.mode("append").parquet(f"{root.rstrip('/')}/manifest"))
    return version


def load(spark: SparkSession, root: str, name: str):
    """The newest version of a model and its manifest row."""
    row = latest_versions(manifest(spark, root).filter(F.col("model") == name)).first()
    if row is None:
        raise LookupError(name)
    return PipelineModel.load(row["path"]), row


def check_features(expected: list, df: DataFrame) -> None:
    """Raise when inputs a manifest names are missing (order follows the manifest)."""
    lead = {"hours_ahead", "sqrt_hours_ahead"}
    needed = [c.removesuffix("_x_hours") for c in expected if c not in lead]
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"inputs missing: {missing}")


def check_model_input(expected: list, df: DataFrame) -> None:
    """Raise unless ``df`` has exactly the manifest's inputs, in the manifest's order."""
    got = df.columns
    missing, extra = sorted(set(expected) - set(got)), sorted(set(got) - set(expected))
    if missing or extra:
        raise ValueError(f"inputs missing: {missing}; not in the manifest: {extra}")
    if list(expected) != got:
        first = next(i for i, (a, b) in enumerate(zip(expected, got, strict=True)) if a != b)
        raise ValueError(f"input {first} is {got[first]}, the manifest says {expected[first]}")
