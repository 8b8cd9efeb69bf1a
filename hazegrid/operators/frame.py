"""Feature rows to training examples: one per row and hour ahead."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.functions.features import epoch_hour, lead_time
from hazegrid.operators.chunks import (CHUNK_HOURS, KEY, add_halo, drop_halo, positions, spread,
                                       with_positions)
from hazegrid.schemas import FEATURES, SPLIT_RATIO


def training_frame(table: DataFrame, first: int, last: int, *, features=FEATURES,
                   target_mode: str = "time", delta: bool = False,
                   size: int = CHUNK_HOURS, carry=()) -> DataFrame:
    """Examples of one forecast block: inputs, ``hours_ahead``, ``y``, ``row_nr``.

    The target is the index ``hours_ahead`` later: by the clock (``"time"``) or by row
    position (``"row"``, where a gap in the table makes the true distance longer).
    ``row_nr`` and ``row_count`` count the station's table rows, so that all examples of
    a row can be kept on one side of a split. The table is shuffled once; the expansion
    itself is narrow. Whether a row is complete is settled ahead of the shuffle, so inputs
    nobody reads further on are not shuffled at all. ``carry`` names further columns to keep.
    """
    whole = " and ".join(f"{c} is not null" for c in features)
    rows = table.count()
    table = table.withColumn("_whole", F.expr(whole))
    if target_mode == "time":
        at = table.withColumn("_at", epoch_hour("ts"))
        frames = spread(add_halo(at, ahead=last, size=size, hour="_at"), rows, KEY, "chunk", joined=True)
        frames = frames.join(positions(table, size), [KEY, "chunk"], "left")
        # halo rows come after a chunk's own rows, so they do not disturb its numbers
        row_nr = F.col("before") + F.row_number().over(
            Window.partitionBy(KEY, "chunk").orderBy("_at")) - 1
        frames = frames.withColumn("row_nr", row_nr)
    elif target_mode == "row":
        at = with_positions(table, size=size).withColumn("_at", F.col("row_nr"))
        frames = spread(add_halo(at, ahead=last, size=size, hour="_at"), rows, KEY, "chunk")
    else:
        raise ValueError(target_mode)
    reach = Window.partitionBy(KEY, "chunk").orderBy("_at").rangeBetween(first, last)
    frames = frames.withColumn("_later", F.collect_list(F.struct("_at", "aqi")).over(reach))
    rows = drop_halo(frames, size, "_at").filter("_whole")
    each = rows.withColumn("_next", F.explode("_later")).filter("_next.aqi is not null")
    later = F.col("_next.aqi")
    examples = each.select(
        KEY, "ts", "row_nr", "row_count", *features, *carry,
        (F.col("_next._at") - F.col("_at")).cast("int").alias("hours_ahead"),
        (later - F.col("aqi") if delta else later).alias("y"))
    return examples.withColumns(lead_time())


def chrono_split(df: DataFrame, ratio: float = SPLIT_RATIO, *, mode: str = "row",
                 embargo_rows: int = 0) -> DataFrame:
    """Add ``split`` (train, test, or embargo): oldest part trains, newest tests.

    ``mode="row"`` splits each station by its number of table rows; ``"time"`` uses one
    moment for all stations. ``embargo_rows`` keeps that many rows ahead of the border
    out of training, as their targets reach into the test period.
    """
    if mode == "row":
        border = F.floor(F.col("row_count") * F.lit(ratio))
        position = F.col("row_nr")
    elif mode == "time":
        ends = df.agg(F.min(epoch_hour("ts")).alias("_low"), F.max(epoch_hour("ts")).alias("_high"))
        # one row on the right: the table's range
        df = df.join(F.broadcast(ends), how="inner")
        border = F.col("_low") + F.floor((F.col("_high") - F.col("_low")) * F.lit(ratio))
        position = epoch_hour("ts")
    else:
        raise ValueError(mode)
    split = (F.when(position >= border, "test")
             .when(position >= border - embargo_rows, "embargo").otherwise("train"))
    return df.withColumn("split", split).drop("_low", "_high")


def day_targets(hourly: DataFrame) -> DataFrame:
    """The index one, two and three days later."""
    from hazegrid.operators.explore import with_leads
    led = with_leads(hourly, [24, 48, 72])
    return led.withColumnsRenamed({f"lead_{24 * d}": f"target_day{d}" for d in (1, 2, 3)})
