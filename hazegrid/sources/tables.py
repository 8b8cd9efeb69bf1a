"""Versioned feature tables on Parquet: write, marks, upsert, source choice, backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazegrid.operators.chunks import KEY
from hazegrid.operators.dedupe import upsert
from hazegrid.operators.quality import high_water_mark
from hazegrid.schemas import FEATURE_SCHEMA

#: Stations whose month shares a folder; a folder per station is too many small files.
GROUP_STATIONS = 64

#: Folders of a stored table: a group of stations (text, so that it is no input) and a month.
PARTITIONS = ["station_group", "month_start"]


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case column names without spaces or dashes."""
    return df.toDF(*[c.lower().replace(" ", "_").replace("-", "_") for c in df.columns])


def widen(df: DataFrame) -> DataFrame:
    """Integers to 64 bit and floats to double, as the table stores them."""
    wide = {"byte": "long", "short": "long", "integer": "long", "float": "double"}
    return df.select(*[F.col(f.name).cast(wide[f.dataType.typeName()]).alias(f.name)
                       if f.dataType.typeName() in wide else F.col(f.name)
                       for f in df.schema.fields])


def storable(df: DataFrame) -> DataFrame:
    df = normalise_names(df)
    if "dominant_pollutant" in df.columns:
        df = df.fillna({"dominant_pollutant": "unknown"})
    return widen(df)


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Version numbers present under a table's folder."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("version="))


def _laid_out(df: DataFrame) -> DataFrame:
    """One file per group of stations and month; a group's months spread over tasks."""
    return with_month(df).repartition(*PARTITIONS).sortWithinPartitions(KEY, "ts")


def write_version(df: DataFrame, path: str, version: int) -> str:
    """Store a feature table as a new version; an existing version is never replaced."""
    target = version_path(path, version)
    _laid_out(storable(df)).write.mode("errorifexists").partitionBy(*PARTITIONS).parquet(target)
    return target


def _with_month(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("station_group", T.StringType()),
                         T.StructField("month_start", T.DateType())])


def with_month(df: DataFrame) -> DataFrame:
    """``df`` with the columns of ``PARTITIONS``."""
    group = F.floor(F.col(KEY) / F.lit(GROUP_STATIONS)).cast("string")
    return df.withColumns({"station_group": F.concat(F.lit("g"), group),
                           "month_start": F.to_date(F.date_trunc("month", "ts"))})


def months_of(df: DataFrame, column: str = "month_start") -> tuple:
    """First and last month of a table, one row to the driver; (None, None) if it is empty."""
    return tuple(df.agg(F.min(column), F.max(column)).first())


def _files(spark: SparkSession, path: str):
    """(file system, path constructor) for a folder."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def pending_path(path: str, version: int) -> str:
    """Where group-months wait that are written but not yet in their place."""
    return f"{path.rstrip('/')}/_pending/version={version}"


def _is_pending(spark: SparkSession, path: str, version: int) -> bool:
    fs, at = _files(spark, path)
    return fs.exists(at(f"{pending_path(path, version)}/_SUCCESS"))


def _put_in_place(spark: SparkSession, waiting: str, target: str) -> None:
    fs, at = _files(spark, target)
    fs.delete(at(target), True)
    fs.mkdirs(at(target).getParent())
    fs.rename(at(waiting), at(target))


def finish_swap(spark: SparkSession, path: str, version: int) -> None:
    """Move waiting group-months to their place; writers call this before they read.

    A folder leaves the waiting place only by its rename, so whatever was under way when a
    writer stopped is taken up where it was. Waiting folders whose write never ended go.
    """
    pending = pending_path(path, version)
    fs, at = _files(spark, pending)
    if not fs.exists(at(pending)):
        return
    if _is_pending(spark, path, version):
        for group in fs.listStatus(at(pending)):
            if group.isDirectory():
                name = group.getPath().getName()
                for month in fs.listStatus(group.getPath()):
                    place = f"{name}/{month.getPath().getName()}"
                    _put_in_place(spark, f"{pending}/{place}", f"{version_path(path, version)}/{place}")
    fs.delete(at(pending), True)


def read_months(spark: SparkSession, path: str, version: int, schema=FEATURE_SCHEMA,
                first=None, last=None, months: list | None = None) -> DataFrame:
    """Rows with their ``station_group`` and ``month_start``, which prunes folders; bounds and months
    are literal.

    Group-months that wait to be put in place (see ``rewrite_months``) are read from where
    they wait, so a writer that stopped half-way hides nothing. Rows without ``ts`` only mark a
    group-month that has become empty and are left out.
    """
    def pruned(folder: str) -> DataFrame:
        rows = spark.read.schema(_with_month(schema)).parquet(folder)
        if first is not None:
            rows = rows.filter(F.col("month_start") >= F.lit(first.isoformat()).cast("date"))
        if last is not None:
            rows = rows.filter(F.col("month_start") <= F.lit(last.isoformat()).cast("date"))
        if months is not None:
            rows = rows.filter(F.col("month_start").isin(
                *[F.lit(m.isoformat()).cast("date") for m in months]) if months else F.lit(False))
        return rows

    rows = pruned(version_path(path, version))
    if _is_pending(spark, path, version):
        waiting = pruned(pending_path(path, version))
        moved = waiting.select(*PARTITIONS).distinct()
        rows = rows.join(moved, PARTITIONS, "left_anti").select(*rows.columns).unionByName(waiting)
    return rows.filter("ts is not null")


def rewrite_months(rows: DataFrame, touched: DataFrame, path: str, version: int) -> None:
    """Put ``rows`` in place of the group-months of ``touched`` (a superset of theirs).

    ``rows`` hold what stays of every station of a group. A group-month that ends up empty gets one row without ``ts``. The new folders are written
    whole beside the table; their success marker is the moment of change, as readers follow it.
    Then each folder is renamed into its place. A writer that stops anywhere leaves the old
    table or the new one, and the next writer ends what is left to rename. One writer at a time.
    """
    spark = rows.sparkSession
    emptied = touched.select(*PARTITIONS).distinct().join(
        rows.select(*PARTITIONS).distinct(), PARTITIONS, "left_anti")
    both = rows.unionByName(emptied, allowMissingColumns=True)
    fs, at = _files(spark, path)
    fs.mkdirs(at(version_path(path, version)))
    (both.repartition(*PARTITIONS).sortWithinPartitions(KEY, "ts").write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(*PARTITIONS)
     .parquet(pending_path(path, version)))
    finish_swap(spark, path, version)


def read_version(spark: SparkSession, path: str, version: int | None = None,
                 schema=FEATURE_SCHEMA) -> DataFrame:
    """A version of the table (the newest by default)."""
    if version is None:
        found = versions(spark, path)
        if not found:
            raise FileNotFoundError(path)
        version = found[-1]
    return read_months(spark, path, version, schema).select(*schema.names)


def table_mark(spark: SparkSession, path: str, version: int) -> DataFrame | None:
    """Newest hour per station; None means there is no such table (not an empty one)."""
    if version not in versions(spark, path):
        return None
    return high_water_mark(read_version(spark, path, version).select(KEY, "ts"))


def newer_than(df: DataFrame, marks: DataFrame | None) -> DataFrame:
    """Rows past their station's mark; a station without a mark keeps all rows."""
    if marks is None:
        return df
    return (df.join(marks.select(KEY, "mark"), KEY, "left")
            .filter(F.col("mark").isNull() | (F.col("ts") > F.col("mark"))).drop("mark"))


def upsert_version(df: DataFrame, path: str, version: int, schema=FEATURE_SCHEMA) -> None:
    """Add rows or replace those with the same station and hour.

    Only the group-months that ``df`` touches are read and rewritten: the folders between
    its first and last month by literal bounds, of those the ones it has rows for. Writing
    the same rows again changes nothing.
    """
    spark = df.sparkSession
    if version not in versions(spark, path):
        write_version(df, path, version)
        return
    finish_swap(spark, path, version)
    fresh = with_month(storable(df))
    first, last = months_of(fresh)
    if first is None:
        return
    touched = fresh.select(*PARTITIONS).distinct()
    existing = read_months(spark, path, version, schema, first, last)
    existing = existing.join(touched, PARTITIONS, "left_semi")
    rewrite_months(upsert(existing, fresh, [KEY, "ts", "month_start"]), touched, path, version)


FORECAST = T.StructType([T.StructField(n, kind) for n, kind in (
    (KEY, T.LongType()), ("hours_ahead", T.IntegerType()), ("ts", T.TimestampType()),
    ("day", T.IntegerType()), ("aqi", T.LongType()), ("category", T.StringType()),
    ("colour", T.StringType()))])


def write_forecast(forecast: DataFrame, path: str) -> None:
    """Replace the forecasts of the days in question, one folder per forecast day."""
    typed = forecast.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FORECAST])
    (typed.repartition("day").sortWithinPartitions(KEY, "hours_ahead")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def read_forecast(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FORECAST).parquet(path).select(*FORECAST.names)


def numeric_features(df: DataFrame, skip=(KEY,)) -> list[str]:
    """Numeric columns of a table in its own order, without keys and targets to come.

    The index itself is an input; its later values (``target_...``) are not.
    """
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip
            and not f.name.startswith("target_")]


def pick_source(primary: DataFrame, candidate: DataFrame, complete: bool = True) -> DataFrame:
    """Which of two copies to read, per station.

    The candidate is taken when its newest hour is later and, with ``complete``, it has
    at least as many rows; a fresh but nearly empty copy must not win.
    """
    def described(df, name):
        return df.groupBy(KEY).agg(F.max("ts").alias(f"{name}_ts"),
                                   F.count(F.lit(1)).alias(f"{name}_rows"))

    both = described(primary, "primary").join(described(candidate, "candidate"), KEY, "full")
    better = F.col("candidate_ts") > F.col("primary_ts")
    if complete:
        better = better & (F.col("candidate_rows") >= F.col("primary_rows"))
    chosen = F.when(F.col("primary_ts").isNull() | F.coalesce(better, F.lit(False)),
                    F.lit("candidate")).otherwise(F.lit("primary"))
    return both.withColumn("chosen", chosen)


def year_chunks(df: DataFrame, start: str = "start", stop: str = "stop") -> DataFrame:
    """Split each row's time range at the turn of every year."""
    first, last = F.col(start), F.col(stop)
    year = F.explode(F.sequence(F.date_trunc("year", first), last, F.expr("interval 1 year")))
    each = df.filter(first < last).withColumn("_year", year)
    following = F.col("_year") + F.expr("interval 1 year")
    return (each.withColumn("chunk_start", F.greatest(first, F.col("_year")))
            .withColumn("chunk_stop", F.least(last, following))
            .filter("chunk_start < chunk_stop").drop("_year"))


def fetch_gap(marks, now: Column) -> DataFrame:
    """What to fetch per station: from the furthest-behind of several destinations.

    ``marks`` are mark tables (or None for a destination that does not exist yet). A
    gap under one hour means the station is up to date.
    """
    known = [m for m in marks if m is not None]
    if not known:
        raise ValueError("no destination holds any data")
    every = known[0].select(KEY, "mark")
    for m in known[1:]:
        every = every.unionByName(m.select(KEY, "mark"))
    behind = every.groupBy(KEY).agg(F.min("mark").alias("fetch_after"))
    gap = F.floor((F.unix_timestamp(now) - F.unix_timestamp("fetch_after")) / 3600)
    return behind.select("*", gap.cast("long").alias("gap_hours"), (gap < 1).alias("up_to_date"))
