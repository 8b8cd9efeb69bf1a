"""Regular hourly series: missing hours inserted, short gaps filled by interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.functions.features import epoch_hour, hour_start
from hazegrid.operators.chunks import CHUNK_HOURS, KEY, add_halo, chunk_of, drop_halo, spread
from hazegrid.schemas import FILL_LIMIT_HOURS, SENSORS


def _per_chunk(frames: DataFrame, sensors, back: int, size: int) -> DataFrame:
    """First and last observation of every sensor in every chunk, its hours and its city.

    ``last`` is over the whole chunk, ``early`` over the part that is not sent to the
    following chunk as its halo. ``frames`` are dealt by station and chunk already, so nothing
    is shuffled. Halo rows are told apart by value: a filter would move ahead of the exchange, and
    the readings would then be shuffled once more for this table.
    """
    aggs = ["min(hour) as first_hour", "max(hour) as last_hour",
            "max(if(city is not null, hour, null)) as city_h",
            "max_by(city, if(city is not null, hour, null)) as city"]
    own = "part < 2"
    either = [f"min(if({own}, first_hour, null)) as first_hour",
              f"max(if({own}, last_hour, null)) as last_hour",
              f"max(if({own}, city_h, null)) as city_h",
              f"max_by(city, if({own}, city_h, null)) as city"]
    for c in sensors:
        seen = f"if({c} is not null, hour, null)"
        aggs += [f"min({seen}) as {c}__min_h", f"min_by({c}, {seen}) as {c}__min_v",
                 f"max({seen}) as {c}__max_h", f"max_by({c}, {seen}) as {c}__max_v"]
        first, last = f"if({own}, {c}__min_h, null)", f"if({own}, {c}__max_h, null)"
        early = f"if(part = 0, {c}__max_h, null)"
        either += [f"min({first}) as {c}__first_h", f"min_by({c}__min_v, {first}) as {c}__first_v",
                   f"max({last}) as {c}__last_h", f"max_by({c}__max_v, {last}) as {c}__last_v",
                   f"max({early}) as {c}__early_h", f"max_by({c}__max_v, {early}) as {c}__early_v"]
    part = (f"case when floor(hour / {size}) <> chunk then 2 "
            f"when pmod(hour, {size}) >= {size - back} then 1 else 0 end as part")
    parts = frames.selectExpr("*", part).groupBy(KEY, "chunk", "part").agg(*map(F.expr, aggs))
    held = parts.groupBy(KEY, "chunk").agg(*map(F.expr, either))
    return held.filter("first_hour is not null")


def _edges(frames: DataFrame, sensors, back: int, size: int) -> DataFrame:
    """Two marker rows per chunk, one hour outside either end of its hours.

    They carry the nearest observations beyond the chunk, so that a gap of any length
    that crosses chunk borders still sees both its ends. Chunks without any reading are
    included. One row per chunk is ordered per station here, never the readings.
    """
    station = f"partition by {KEY}"
    held = _per_chunk(frames, sensors, back, size).selectExpr(
        "* except (city, city_h)", f"max_by(city, city_h) over ({station}) as city",
        f"min(first_hour) over ({station}) as start",
        f"max(last_hour) over ({station}) as stop",
        f"coalesce(lead(chunk) over ({station} order by chunk) - 1, chunk) as until")
    chunks = held.selectExpr("*", "explode(sequence(chunk, until)) as at")
    parts = [f"{c}__{kind}_{part}" for c in sensors for kind in ("first", "last", "early")
             for part in ("h", "v")]
    dense = chunks.selectExpr(
        KEY, "start", "stop", "at as chunk", "city",
        *[f"if(at = chunk, {n}, null) as {n}" for n in parts])

    order = f"{station} order by chunk"
    behind = f"({order} rows between unbounded preceding and 2 preceding)"
    beyond = (f"({station} order by chunk desc rows between unbounded preceding "
              "and 1 preceding)")
    carried = []
    for c in sensors:
        for part in ("h", "v"):
            carried += [
                f"coalesce(lag({c}__early_{part}) over ({order}), "
                f"last({c}__last_{part}, true) over {behind}) as {c}__p_{part}",
                f"last({c}__first_{part}, true) over {beyond} as {c}__n_{part}"]
    carried = dense.selectExpr(
        KEY, "chunk", "city", f"greatest(start, chunk * {size} - {back}) - 1 as low",
        f"least(stop, (chunk + 1) * {size} - 1) + 1 as high", *carried)

    def marker(side, hour):
        fields = [f"'hour', {hour}"]
        fields += [f"'{c}', {c}__{side}_v" for c in sensors]
        fields.append("'seen', " + _struct([f"'{c}', {c}__{side}_h" for c in sensors]))
        return _struct(fields)

    return carried.selectExpr(
        KEY, "chunk", "city", "true as edge",
        f"inline(array({marker('p', 'low')}, {marker('n', 'high')}))")


def _struct(fields) -> str:
    return f"named_struct({', '.join(fields)})"


def grid_hours(rows: DataFrame) -> int:
    """Hours between first and last reading, summed over stations; one row to the driver."""
    spans = rows.groupBy(KEY).agg((F.max("hour") - F.min("hour") + 1).alias("hours"))
    return int(spans.agg(F.sum("hours")).first()[0] or 0)


def hourly_frames(merged: DataFrame, sensors=SENSORS, back: int = 0,
                 size: int = CHUNK_HOURS) -> DataFrame:
    """Readings of every chunk (halo included) with its edge markers, as one row per known hour.

    ``<sensor>__h`` is the hour of a sensor's value, ``following`` the next known hour. Readings
    are shuffled once, edges are made from the shuffled rows and join them in their tasks. The
    number of tasks follows the hours of the grid, not the bytes of the readings.
    """
    rows = merged.withColumn("hour", epoch_hour("ts"))
    city = "city" if "city" in merged.columns else "cast(null as string) as city"
    rows = rows.selectExpr(KEY, "hour", city, *sensors)
    hours = grid_hours(rows) * (size + back) // size
    readings = spread(add_halo(rows, back, size=size).select(KEY, "chunk", "city", "hour", *sensors),
                      hours, KEY, "chunk")
    edges = spread(_edges(readings, sensors, back, size), hours, KEY, "chunk")
    # a reading's hours follow from its values, so they are not shuffled
    known = edges.unionByName(readings.withColumns({
        "edge": F.lit(False), "seen": F.lit(None).cast(edges.schema["seen"].dataType)}))
    known = known.selectExpr(
        KEY, "chunk", "city", "edge", "hour", *sensors,
        *[f"if(edge, seen.{c}, if({c} is not null, hour, null)) as {c}__h" for c in sensors])
    return known.selectExpr(
        "*", f"lag(hour) over (partition by {KEY}, chunk order by hour desc) as following")


#: Every hour from a known one to the next, and which of them are no markers.
_UNTIL_NEXT = "explode(sequence(hour, coalesce(following - 1, hour))) as at"
_NOT_EDGE = "not (edge and at = hour)"


def interpolated(c: str, limit: int = FILL_LIMIT_HOURS, mode: str = "both",
                 quantum: float | None = None) -> str:
    """A missing value of sensor ``c`` on the line between its neighbours in time.

    ``mode="both"``: filled where either neighbour is at most ``limit`` hours away, so
    a longer gap keeps a hole in its middle; past the first or last observation the
    nearest value is repeated. ``mode="whole_gap"``: only gaps of at most ``limit``
    hours are filled. ``quantum`` floors filled values to the sensor's resolution.
    """
    before, after = f"{c}__prev", f"{c}__next"
    since, till = f"(hour - {c}__h__prev)", f"({c}__h__next - hour)"
    guess = (f"coalesce({before} + ({after} - {before}) * {since} / ({since} + {till}), "
             f"{before}, {after})")
    if mode == "both":
        near = f"coalesce({since} <= {limit}, false) or coalesce({till} <= {limit}, false)"
    elif mode == "whole_gap":
        near = f"coalesce({since} + {till} - 1 <= {limit}, false)"
    else:
        raise ValueError(mode)
    if quantum:
        guess = f"cast(floor({guess} / {quantum!r}D) as double) * {quantum!r}D"
    return f"case when {c} is not null then {c} when {near} then {guess} end"


def filled_frames(merged: DataFrame, sensors=SENSORS, back: int = 0, *,
                  limit: int = FILL_LIMIT_HOURS, mode: str = "both",
                  quantum: float | None = None, size: int = CHUNK_HOURS) -> DataFrame:
    """The hourly grid per chunk, halo included, with short gaps interpolated."""
    sensors = [c for c in sensors if c in merged.columns]
    frames = hourly_frames(merged, sensors, back, size)
    both = [n for c in sensors for n in (c, f"{c}__h")]
    upto = "rows between unbounded preceding and current row"
    # what follows an hour without a reading is what follows the known hour before it
    down = f"(partition by {KEY}, chunk order by hour desc rows between unbounded preceding and 1 preceding)"
    up = f"(partition by {KEY}, chunk order by hour {upto})"
    frames = frames.selectExpr("*", *[f"last({n}, true) over {down} as {n}__next" for n in both])
    frames = frames.selectExpr("*", f"last(city, true) over {up} as filled_city",
                               *[f"last({n}, true) over {up} as {n}__prev" for n in both])
    frames = frames.selectExpr("*", _UNTIL_NEXT).filter(_NOT_EDGE).selectExpr(
        KEY, "chunk", "at as hour", "filled_city as city",
        *[f"if(at = hour, {c}, null) as {c}" for c in sensors],
        *[f"{n}__{side}" for n in both for side in ("prev", "next")])
    return frames.selectExpr(
        KEY, "chunk", "hour", "city",
        *[f"{interpolated(c, limit, mode, quantum)} as {c}" for c in sensors])


def hourly_grid(merged: DataFrame, sensors=SENSORS, size: int = CHUNK_HOURS) -> DataFrame:
    """One row per station and hour between its first and last reading."""
    sensors = [c for c in sensors if c in merged.columns]
    frames = hourly_frames(merged, sensors, 0, size).selectExpr("*", _UNTIL_NEXT)
    return frames.filter(_NOT_EDGE).select(
        KEY, hour_start("at").alias("ts"),
        *[F.expr(f"if(at = hour, {c}, null) as {c}") for c in sensors])


def interpolate(merged: DataFrame, sensors=SENSORS, **options) -> DataFrame:
    """The hourly grid with short gaps filled."""
    sensors = [c for c in sensors if c in merged.columns]
    frames = drop_halo(filled_frames(merged, sensors, 0, **options),
                       options.get("size", CHUNK_HOURS))
    return frames.select(KEY, hour_start("hour").alias("ts"), "city", *sensors)
