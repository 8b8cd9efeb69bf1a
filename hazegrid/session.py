"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # The JVM never compiles methods above 8000 bytecodes; a fused stage with dozens of
    # sensor columns passes that and would run interpreted, so let Spark split it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that sorts the rows of a split or of a shuffle holds them at many times their packed size.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24m",
    "spark.sql.parquet.compression.codec": "zstd",
    # What a job shuffled goes when the job ends, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

#: Settings a running session can still take.
LIVE_SETTINGS = ["spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit",
                 "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                 "spark.sql.parquet.compression.codec",
                 "spark.sql.classic.shuffleDependency.fileCleanup.enabled"]


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def prepare(spark: SparkSession) -> SparkSession:
    """Calendar parts and day boundaries are UTC; see SETTINGS for the rest."""
    for key in LIVE_SETTINGS:
        if spark.conf.get(key, None) != SETTINGS[key]:
            spark.conf.set(key, SETTINGS[key])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent, as in tests, a folder inside the warehouse is set,
    which driver and executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and go on from the files.

    Cuts lineage, keeps column pruning and filter pushdown for what follows, and
    survives the loss of executors.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the folders of written tables that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        root = f"{shared_folder(spark)}/"
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/")):
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
