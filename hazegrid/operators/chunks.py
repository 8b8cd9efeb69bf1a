"""Splitting one long series over many tasks.

A window over ``station_id`` alone would put a station's whole history into one task,
and one station may hold a third of all rows. Windows here run over
``(station_id, chunk)`` instead, where a chunk is a fixed stretch of hours:

* frames of bounded reach get a halo: the last hours of a chunk are also sent to the
  following chunk (and, for leads, the first hours to the preceding one);
* reach without a bound (row numbers, previous row) goes through one summary row per
  chunk, which is small enough to be ordered per station.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.functions.features import epoch_hour
from hazegrid.session import written

#: Twelve weeks of hours; the feature halo of 191 hours adds under ten percent.
CHUNK_HOURS = 2016

KEY = "station_id"

#: Rows of a wide frame that one task sorts: under 200 MB, a fraction of a task's memory.
TASK_ROWS = 200_000


def chunk_of(hour, size: int = CHUNK_HOURS) -> Column:
    hour = F.col(hour) if isinstance(hour, str) else hour
    return F.floor(hour / F.lit(size)).cast("long")


def add_halo(df: DataFrame, back: int = 0, ahead: int = 0, size: int = CHUNK_HOURS,
             hour: str = "hour") -> DataFrame:
    """Copy each row into every chunk whose windows can reach it (column ``chunk``)."""
    if back > size or ahead > size:
        raise ValueError("halo longer than a chunk")
    home, offset = chunk_of(hour, size), F.pmod(F.col(hour), F.lit(size))
    places = [home]
    if back:
        places.append(F.when(offset >= size - back, home + 1))
    if ahead:
        places.append(F.when(offset < ahead, home - 1))
    if len(places) == 1:
        return df.withColumn("chunk", home)
    return df.withColumn("chunk", F.explode(F.array_compact(F.array(*places))))


def drop_halo(df: DataFrame, size: int = CHUNK_HOURS, hour: str = "hour") -> DataFrame:
    return df.filter(F.col("chunk") == chunk_of(hour, size))


def chunk_window(order: str = "hour") -> Window:
    return Window.partitionBy(KEY, "chunk").orderBy(order)


def spread(df: DataFrame, rows: int, *keys, per_task: int = TASK_ROWS, joined: bool = False) -> DataFrame:
    """Deal ``df`` by ``keys`` to as many tasks as ``rows`` need, so that their sorts fit in memory.

    Sizes of shuffled bytes do not tell: sparse, compressed rows become many wide ones later.
    ``joined`` is for rows that a join by the same keys follows: Spark shuffles a side again that has
    fewer parts than its own shuffles.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    if joined:
        least = max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(max(least, -(-rows // per_task)), *keys)


def positions(df: DataFrame, size: int = CHUNK_HOURS, ts: str = "ts") -> DataFrame:
    """Rows before each chunk and in the whole series, one row per chunk."""
    counts = df.groupBy(KEY, chunk_of(epoch_hour(ts), size).alias("chunk")).agg(
        F.count(F.lit(1)).alias("rows"))
    station = Window.partitionBy(KEY)
    running = station.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(KEY, "chunk",
                         F.coalesce(F.sum("rows").over(running), F.lit(0)).alias("before"),
                         F.sum("rows").over(station).alias("row_count"))


def with_positions(df: DataFrame, *, ts: str = "ts", keep=None,
                   size: int = CHUNK_HOURS) -> DataFrame:
    """Number each station's rows by time from 0 (``row_nr``) and add ``row_count``.

    ``keep`` (a function of the per-chunk table with ``before``, ``rows`` and
    ``row_count``) drops chunks that cannot hold wanted rows ahead of the numbering.
    """
    marked = df.withColumn("chunk", chunk_of(epoch_hour(ts), size))
    per_chunk = marked.groupBy(KEY, "chunk").agg(F.count(F.lit(1)).alias("rows"))
    station = Window.partitionBy(KEY)
    running = station.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(
        KEY, "chunk", "rows",
        F.coalesce(F.sum("rows").over(running), F.lit(0)).alias("before"),
        F.sum("rows").over(station).alias("row_count"))
    if keep is not None:
        offsets = offsets.filter(keep(offsets))
    inside = F.row_number().over(Window.partitionBy(KEY, "chunk").orderBy(ts)) - 1
    return (marked.join(offsets.drop("rows"), [KEY, "chunk"])
            .withColumn("row_nr", F.col("before") + inside)
            .drop("chunk", "before"))


def last_rows(df: DataFrame, n: int, ts: str = "ts") -> DataFrame:
    """The newest ``n`` rows of each station; only chunks that reach them are read on."""
    numbered = with_positions(
        df, ts=ts, keep=lambda o: o["before"] + o["rows"] > o["row_count"] - n)
    return numbered.filter(F.col("row_nr") >= F.col("row_count") - n)


def newest_rows(df: DataFrame, n: int, ts: str = "ts") -> DataFrame:
    """``last_rows`` without its numbers: a scan with one small row per station beside it, no shuffle.

    A station has one row per time, so its newest rows are those from the last but ``n``-th time on.
    """
    cut = last_rows(df.select(KEY, ts), n, ts).groupBy(F.col(KEY).alias("_key")).agg(
        F.min(ts).alias("_cut"))
    # one small row per station; a join by shuffle would move every wide row
    late = df.join(F.broadcast(written(cut, "cuts")), (F.col(KEY) == F.col("_key")) & (F.col(ts) >= F.col("_cut")))
    return late.select(*df.columns)


def with_previous(df: DataFrame, columns, *, ts: str = "ts", prefix: str = "prev_",
                  size: int = CHUNK_HOURS) -> DataFrame:
    """Add each station's preceding row's values, however long ago that row is.

    A station has one row per time. The newest row of a chunk is picked column by column,
    which for numbers is a hash aggregation without sorting rows.
    """
    marked = df.withColumn("chunk", chunk_of(epoch_hour(ts), size))
    wanted = list(columns)
    newest = marked.groupBy(KEY, "chunk").agg(
        F.struct(F.max(ts).alias(ts), *[F.max_by(c, ts).alias(c) for c in wanted if c != ts])
        .alias("newest"))
    by_chunk = Window.partitionBy(KEY).orderBy("chunk")
    carried = newest.select(KEY, "chunk", F.lag("newest").over(by_chunk).alias("carried"))
    w = chunk_window(ts)
    first = F.row_number().over(w) == 1
    out = marked.join(carried, [KEY, "chunk"])
    return out.select(
        *df.columns,
        *[F.when(first, F.col("carried")[c]).otherwise(F.lag(c).over(w)).alias(prefix + c)
          for c in wanted])


def fill_both_ways(df: DataFrame, columns, *, ts: str = "ts",
                   size: int = CHUNK_HOURS) -> DataFrame:
    """Forward fill each station's gaps, then backward fill what is left at the start."""
    marked = df.withColumn("chunk", chunk_of(epoch_hour(ts), size))
    wanted = list(columns)
    known = []
    for c in wanted:
        seen = F.when(F.col(c).isNotNull(), F.col(ts))
        known += [F.max_by(c, seen).alias(f"{c}__last"), F.min_by(c, seen).alias(f"{c}__first")]
    ends = marked.groupBy(KEY, "chunk").agg(*known)
    ahead = (Window.partitionBy(KEY).orderBy("chunk")
             .rowsBetween(Window.unboundedPreceding, -1))
    behind = (Window.partitionBy(KEY).orderBy(F.desc("chunk"))
              .rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(
        KEY, "chunk",
        *[F.last(f"{c}__last", ignorenulls=True).over(ahead).alias(f"{c}__before")
          for c in wanted],
        *[F.last(f"{c}__first", ignorenulls=True).over(behind).alias(f"{c}__after")
          for c in wanted])
    up = chunk_window(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = (Window.partitionBy(KEY, "chunk").orderBy(F.desc(ts))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(up), F.col(f"{c}__before"),
                            F.last(c, ignorenulls=True).over(down), F.col(f"{c}__after"))
              for c in wanted}
    return marked.join(ends, [KEY, "chunk"]).select(
        *[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
