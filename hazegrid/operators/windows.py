"""Windowed columns over the hourly grid.

Every function takes frames keyed by ``(station_id, chunk, hour)``. All windows share
one partitioning and one order, so the whole set costs one exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazegrid.functions import index as aqi
from hazegrid.operators.chunks import KEY
from hazegrid.schemas import (AVERAGING, LAGS, POLLUTANT_WINDOWS, ROLLING, TRENDS,
                              WEATHER_MEANS)

#: Hours a feature can look back: a week's lag of an index that averages 24 hours.
BACK_HOURS = max(LAGS) + max(n for n, _ in AVERAGING.values()) - 1


#: Running totals are kept in whole millionths, so they are exact and free of order.
UNITS = 1e6


_SERIES = f"partition by {KEY}, chunk order by hour"


def sliding(call: str, hours: int) -> str:
    """An aggregate over the last ``hours`` rows; each row visits its whole frame."""
    return f"{call} over ({_SERIES} rows between {hours - 1} preceding and current row)"


def lagged(column: str, hours: int) -> str:
    return f"lag({column}, {hours}) over ({_SERIES})"


def adding(frames: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``frames`` with columns added or replaced, given as SQL text."""
    return frames.selectExpr(*[c for c in frames.columns if c not in columns],
                             *[f"{text} as {name}" for name, text in columns.items()])


def _totals(column: str, squares: bool) -> dict[str, str]:
    running = f"over ({_SERIES} rows between unbounded preceding and current row)"
    # the index is whole numbers already, sensors are fractions
    value = (f"cast({column} as long)" if squares
             else f"cast(rint({column} * {UNITS!r}D) as long)")
    out = {f"{column}__n": f"count({column}) {running}",
           f"{column}__s": f"coalesce(sum({value}) {running}, 0L)"}
    if squares:
        out[f"{column}__q"] = f"coalesce(sum({value} * {value}) {running}, 0L)"
    return out


def with_totals(frames: DataFrame, columns, more: dict | None = None,
                squares: bool = False) -> DataFrame:
    """Running count and sum of each column within its chunk (and other windows)."""
    totals = {}
    for c in columns:
        totals |= _totals(c, squares)
    return adding(frames, totals | (more or {}))


def moving(frames: DataFrame, specs) -> DataFrame:
    """Counts and sums over the last hours as differences of running totals.

    ``specs`` holds (column, hours, parts) with parts out of "nsq"; the cost per row
    does not depend on the length of the window. Adds ``<column>__<part>_<hours>``.
    """
    return adding(frames, {
        f"{c}__{part}_{hours}": f"{c}__{part} - lag({c}__{part}, {hours}, 0L) over ({_SERIES})"
        for c, hours, parts in specs for part in parts})


def moving_mean(column: str, hours: int, least: int) -> str:
    n, s = f"{column}__n_{hours}", f"{column}__s_{hours}"
    return f"if({n} >= {least}, cast({s} as double) / (cast({n} as double) * {UNITS!r}D), null)"


def moving_sum(column: str, hours: int, least: int) -> str:
    n, s = f"{column}__n_{hours}", f"{column}__s_{hours}"
    return f"if({n} >= {least}, cast({s} as double) / {UNITS!r}D, null)"


def whole_mean(column: str, hours: int, least: int) -> str:
    n, s = f"{column}__n_{hours}", f"{column}__s_{hours}"
    return f"if({n} >= {least}, cast({s} as double) / cast({n} as double), null)"


def whole_std(column: str, hours: int, least: int) -> str:
    """Sample deviation of whole numbers, from exact sums."""
    n, s, q = (f"cast({column}__{p}_{hours} as double)" for p in "nsq")
    return (f"if({n} >= {least} and {n} > 1, "
            f"sqrt(({n} * {q} - {s} * {s}) / ({n} * ({n} - 1D))), null)")


def without_totals(frames: DataFrame) -> DataFrame:
    return frames.drop(*[c for c in frames.columns if "__n" in c or "__s" in c or "__q" in c])


def with_averages(frames: DataFrame, weather: bool = True) -> DataFrame:
    """Index averages (24 h particles, 8 h gases) and the sensors' own windows."""
    more = {}
    columns = list(AVERAGING)
    specs = {(p, hours) for p, (hours, _) in AVERAGING.items()}
    if weather:
        columns += WEATHER_MEANS + ["precipitation"]
        specs |= {(p, 24) for p in [*POLLUTANT_WINDOWS, *WEATHER_MEANS, "precipitation"]}
        specs |= {("precipitation", 72)}
        more = {f"{p}_lag_24h": lagged(p, 24) for p in POLLUTANT_WINDOWS}
        more["pressure_trend_24h"] = f"pressure - {lagged('pressure', 24)}"
        more["temp_range_24h"] = (f"{sliding('max(temperature)', 24)} - "
                                  f"{sliding('min(temperature)', 24)}")
    frames = with_totals(frames, columns, more)
    frames = moving(frames, [(c, hours, "ns") for c, hours in sorted(specs)])
    out = {f"{p}_avg": moving_mean(p, hours, least)
           for p, (hours, least) in AVERAGING.items()}
    if weather:
        out |= {f"{c}_roll_24h": moving_mean(c, 24, 6)
                for c in POLLUTANT_WINDOWS + WEATHER_MEANS}
        out["temp_range_24h"] = "if(temperature__n_24 >= 6, temp_range_24h, null)"
        out["precip_24h"] = moving_sum("precipitation", 24, 6)
        out["precip_72h"] = moving_sum("precipitation", 72, 12)
    return without_totals(adding(frames, out))


def with_index(frames: DataFrame, scales=aqi.SCALES) -> DataFrame:
    """Index and dominant pollutant from the averages."""
    subs = aqi.sub_indices(**{p: f"{p}_avg" for p in AVERAGING}, scales=scales)
    named = frames.withColumns({f"{p}_sub": c for p, c in subs.items()})
    columns = {p: f"{p}_sub" for p in subs}
    return (named.withColumns({"aqi": aqi.overall(columns.values()),
                               "dominant_pollutant": aqi.dominant(columns)})
            .drop(*columns.values(), *[f"{p}_avg" for p in AVERAGING]))


def with_aqi_windows(frames: DataFrame, extended: bool = False) -> DataFrame:
    """Lags, moving mean, deviation, extremes and trends of the index."""
    more = {f"aqi_lag_{h}h": lagged("aqi", h) for h in LAGS}
    more |= {f"aqi_roll_{fn}_1d": sliding(f"{fn}(aqi)", 24) for fn in ("max", "min")}
    if extended:
        more |= {f"aqi_{name}_24h": sliding(call, 24) for name, call in (
            ("max", "max(aqi)"), ("min", "min(aqi)"), ("median", "percentile(aqi, 0.5)"))}
        more |= {f"{c}_lag24": lagged(c, 24) for c in EXTENDED_WEATHER}
    frames = with_totals(frames, ["aqi"], more, squares=True)
    frames = moving(frames, [("aqi", hours, "nsq") for _, hours, _ in ROLLING])
    out = {}
    for name, hours, least in ROLLING:
        out[f"aqi_roll_mean_{name}"] = whole_mean("aqi", hours, least)
        out[f"aqi_roll_std_{name}"] = whole_std("aqi", hours, least)
    out |= {c: f"if(aqi__n_24 >= 6, {c}, null)" for c in ("aqi_roll_max_1d", "aqi_roll_min_1d")}
    if extended:
        out |= _extended_moments()
    frames = without_totals(adding(frames, out))
    frames = adding(frames, {
        "aqi_range_1d": "aqi_roll_max_1d - aqi_roll_min_1d",
        **{f"aqi_trend_{h}h": f"aqi - aqi_lag_{h}h" for h in TRENDS},
        "aqi_vs_7d": "aqi - aqi_roll_mean_7d"})
    return adding(frames, _extended_differences()) if extended else frames


# --- fixed values: columns the extended set looks back on by a day ---
EXTENDED_WEATHER = ["temperature", "humidity", "pressure", "wind_speed", "wind_deg",
                    "clouds"]


def _extended_moments() -> dict[str, str]:
    return {"aqi_rolling_3d": whole_mean("aqi", 72, 1),
            "aqi_rolling_7d": whole_mean("aqi", 168, 1),
            "aqi_rolling_3d_std": whole_std("aqi", 72, 24),
            "aqi_rolling_7d_std": whole_std("aqi", 168, 48),
            "aqi_std_24h": whole_std("aqi", 24, 12),
            **{c: f"if(aqi__n_24 >= 12, {c}, null)"
               for c in ("aqi_max_24h", "aqi_min_24h", "aqi_median_24h")}}


def _extended_differences() -> dict[str, str]:
    """Changes and trends earlier model generations use, named by their two lags."""
    return {**{f"aqi_change_{h}h": f"aqi - aqi_lag_{h}h" for h in (1, 3, 6, 24)},
            **{f"aqi_lag1_trend_{h}h": f"aqi_lag_1h - aqi_lag_{h}h" for h in (6, 12, 24)},
            **{f"aqi_lag24_trend_{h}h": f"aqi_lag_24h - aqi_lag_{h}h" for h in (48, 72)},
            "aqi_range_24h": "aqi_max_24h - aqi_min_24h",
            **{f"{c}_diff24": f"{c} - {c}_lag24" for c in EXTENDED_WEATHER},
            **{f"persistence_{h}h": "aqi_rolling_7d" for h in (24, 48, 72)}}
