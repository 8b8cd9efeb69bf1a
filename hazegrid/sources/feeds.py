"""Raw feeds: payload documents and raw tables to typed, hourly, clean readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazegrid.functions.index import known
from hazegrid.operators.chunks import KEY
from hazegrid.operators.dedupe import ROW_KEY, keep_last
from hazegrid.schemas import (MERGED_SCHEMA, POLLUTANT_PAYLOAD, POLLUTANTS, SENSORS,
                              SENTINEL, WEATHER, WEATHER_PAYLOAD, WEATHER_VARIABLES)


def clean(value: str, sentinel: float = SENTINEL) -> Column:
    """A failed sensor's marker and NaN become NULL."""
    return F.expr(f"nullif({known(value)}, {sentinel!r}D)")


def clean_sentinel(df: DataFrame, columns=SENSORS, sentinel: float = SENTINEL) -> DataFrame:
    return df.withColumns({c: clean(c, sentinel) for c in columns if c in df.columns})


#: Columns that only some weather feeds have and no later step reads.
OPTIONAL = ("boundary_layer_height",)


def drop_optional(df: DataFrame, columns=OPTIONAL) -> DataFrame:
    """``df`` without its optional columns; a column it lacks is no error."""
    return df.drop(*columns)


def drop_sentinel(df: DataFrame, columns=("pm10", "no2", "o3"),
                  sentinel: float = SENTINEL) -> DataFrame:
    """Drop rows where any of the columns holds the marker (a missing value stays)."""
    for c in columns:
        df = df.filter(F.coalesce(F.col(c) != F.lit(sentinel), F.lit(True)))
    return df


def flatten_readings(documents: DataFrame) -> DataFrame:
    """Pollutant payloads (column ``list``) to one row per reading.

    Whatever other columns the documents have (station, city, arrival) are kept.
    """
    rest = [c for c in documents.columns if c != "list"]
    each = documents.select(*rest, F.explode("list").alias("reading"))
    return each.select(
        *rest, F.timestamp_seconds("reading.dt").alias("ts"),
        *[clean(f"reading.components.{p}").alias(p) for p in POLLUTANTS])


def flatten_weather(documents: DataFrame) -> DataFrame:
    """Weather payloads (column ``hourly``, parallel arrays) to one row per time.

    A variable the payload lacks is a NULL column. Times of 16 characters have no
    seconds and no zone; all times are UTC.
    """
    rest = [c for c in documents.columns if c != "hourly"]
    time = F.col("hourly.time")
    series = [F.coalesce(F.col(f"hourly.{v}"),
                         F.array_repeat(F.lit(None).cast("double"), F.size(time))).alias(name)
              for v, name in WEATHER_VARIABLES.items()]
    rows = documents.select(*rest, time.alias("time"), *series)
    names = list(WEATHER_VARIABLES.values())
    zipped = rows.select(*rest, F.explode(F.arrays_zip("time", *names)).alias("row"))
    text = F.col("row.time")
    padded = F.when(F.length(text) == 16, F.concat(text, F.lit(":00+00:00"))).otherwise(text)
    return zipped.select(*rest, F.to_timestamp(padded).alias("ts"),
                         *[F.col(f"row.{n}").alias(n) for n in names])


def parse_payload(documents: DataFrame, column: str, schema) -> DataFrame:
    """Text column with one JSON document per row to that document's top fields."""
    parsed = documents.withColumn("_doc", F.from_json(F.col(column), schema))
    return parsed.select(*[c for c in documents.columns if c != column], "_doc.*")


def _landed(payload: T.StructType) -> T.StructType:
    return T.StructType([*payload.fields, T.StructField(KEY, T.LongType())])


def read_pollutant_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landing folder ``station_id=N/*.json`` of pollutant payloads."""
    return flatten_readings(spark.read.schema(_landed(POLLUTANT_PAYLOAD)).json(path))


def read_weather_landing(spark: SparkSession, path: str) -> DataFrame:
    return flatten_weather(spark.read.schema(_landed(WEATHER_PAYLOAD)).json(path))


def read_raw(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Raw table scan with a given schema; times are UTC and cut to the hour."""
    options = {"header": True} if fmt == "csv" else {}
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def to_hour(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(ts, F.date_trunc("hour", F.col(ts).cast("timestamp")))


def hourly_readings(raw: DataFrame, arrival=("arrival",)) -> DataFrame:
    """One clean row per station and hour: the last to arrive."""
    return keep_last(clean_sentinel(to_hour(raw)), ROW_KEY, arrival)


def merge_sources(pollutants: DataFrame, weather: DataFrame, arrival=("arrival",)) -> DataFrame:
    """Hours with both feeds.

    Both sides are reduced to one row per station and hour first, and the join reuses
    the partitioning of that reduction: each feed is shuffled once.
    """
    left = hourly_readings(pollutants, arrival)
    right = hourly_readings(drop_optional(weather), arrival)
    if "city" not in left.columns:
        left = left.withColumn("city", F.lit(None).cast("string"))
    return (left.select(*ROW_KEY, "city", *POLLUTANTS)
            .join(right.select(*ROW_KEY, *WEATHER), ROW_KEY, "inner")
            .select(*MERGED_SCHEMA.names))
