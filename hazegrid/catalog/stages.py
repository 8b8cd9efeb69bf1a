"""SQL text of the pipeline stages, from the given tables to the feature table.

Written for an engine without any of this package: the checks compare its results with
ours value by value.
"""

from __future__ import annotations

from hazegrid.functions import index as aqi
from hazegrid.functions.features import SEASONS
from hazegrid.schemas import (AVERAGING, FEATURES, LAGS, POLLUTANT_WINDOWS, POLLUTANTS,
                              ROLLING, SENSORS, TRENDS, WEATHER, WEATHER_MEANS)
from hazegrid.sources.fixtures import ARRIVAL, feed_sql

NEWEST = ", ".join(f"{c} desc" for c in ARRIVAL)


def sub_index_sql(value: str, scale: aqi.Scale) -> str:
    f = float(10 ** scale.decimals)
    cut = f"(floor(({value}) * {f}) / {f})"

    def line(row):
        low, high, i_low, i_high = (float(v) for v in row)
        return (f"round_even(({i_high} - {i_low})::double / ({high}::double - {low}::double)"
                f" * ({cut} - {low}::double) + {i_low}::double, 0)")

    whens = " ".join(f"when {cut} between {float(r[0])}::double and {float(r[1])}::double "
                     f"then {line(r)}" for r in scale.rows)
    return (f"case when ({value}) is null then null when {cut} < {float(scale.rows[0][0])} "
            f"then 0.0::double {whens} else {line(scale.rows[-1])} end")


def category_sql(value: str, part: int = 2) -> str:
    whens = " ".join(f"when round_even({value}, 0) between {r[0]} and {r[1]} then '{r[part]}'"
                     for r in aqi.CATEGORIES)
    return (f"case when ({value}) is null then '{aqi.UNKNOWN[part - 2]}' {whens} "
            f"else '{aqi.CATEGORIES[-1][part]}' end")


def _clean(columns):
    return ", ".join(f"nullif({c}::double, -9999.0) as {c}" for c in columns)


def _newest_per_hour(source, columns, extra=""):
    return (f"select * from (select station_id, date_trunc('hour', ts) as ts{extra}, "
            f"{_clean(columns)}, row_number() over (partition by station_id, "
            f"date_trunc('hour', ts) order by {NEWEST}) as rn from {source}) where rn = 1")


def _filled(limit="kp <= 3 or kn <= 3"):
    cols = []
    for c in SENSORS:
        guess = (f"coalesce({c}__pv + ({c}__nv - {c}__pv) * (h - {c}__ph) "
                 f"/ (({c}__nh - h) + (h - {c}__ph)), {c}__pv, {c}__nv)")
        near = limit.replace("kp", f"(h - {c}__ph)").replace("kn", f"({c}__nh - h)")
        cols.append(f"case when {c} is not null then {c} when {near} "
                    f"then {guess} end as {c}")
    return "select station_id, ts, h, city, " + ", ".join(cols) + " from seen"


def _seen():
    up = "(partition by station_id order by h rows between unbounded preceding and current row)"
    down = ("(partition by station_id order by h desc rows between unbounded preceding "
            "and current row)")
    cols = []
    for c in SENSORS:
        hour = f"case when {c} is not null then h end"
        for side, w in (("p", up), ("n", down)):
            cols.append(f"last_value({c} ignore nulls) over {w} as {c}__{side}v")
            cols.append(f"last_value({hour} ignore nulls) over {w} as {c}__{side}h")
    city = (f"coalesce(last_value(city ignore nulls) over {up}, "
            f"last_value(city ignore nulls) over {down})")
    return (f"select station_id, ts, h, {city} as city, {', '.join(SENSORS)}, "
            + ", ".join(cols) + " from grid")


def _over(hours):
    return f"(partition by station_id order by h rows between {hours - 1} preceding and current row)"


def roll_sql(fn, c, hours, least):
    return (f"case when count({c}) over {_over(hours)} >= {least} "
            f"then {fn}({c}) over {_over(hours)} end")


def units_sql(fn, c, hours, least):
    """Sum or mean of fractions in whole millionths, which no order of adding changes."""
    total = f"(sum(round_even({c} * 1000000.0::double, 0)::bigint) over {_over(hours)})::double"
    n = f"(count({c}) over {_over(hours)})"
    whole = "1000000.0::double" if fn == "sum" else f"({n}::double * 1000000.0::double)"
    return f"case when {n} >= {least} then {total} / {whole} end"


def std_sql(c, hours, least):
    o = _over(hours)
    n, s, q = f"(count({c}) over {o})", f"(sum({c}) over {o})", f"(sum({c} * {c}) over {o})"
    return (f"case when {n} >= {least} and {n} > 1 then "
            f"sqrt(({n} * {q} - {s} * {s}) / ({n} * ({n} - 1.0::double))) end")


def lag_sql(c, hours):
    return f"lag({c}, {hours}) over (partition by station_id order by h)"


def _averaged():
    return ("select *, " + ", ".join(
        f"{units_sql('avg', p, hours, least)} as {p}_avg"
        for p, (hours, least) in AVERAGING.items()) + " from filled")


def _indexed():
    inputs = {"pm2_5": "pm2_5_avg", "pm10": "pm10_avg", "co": f"co_avg / {aqi.CO_PER_PPM}",
              "o3": f"o3_avg / {aqi.O3_PER_PPB}"}
    return ("select *, " + ", ".join(
        f"{sub_index_sql(inputs[p], scale)} as {p}_sub" for p, scale in aqi.SCALES.items())
        + " from averaged")


def _hourly():
    subs = [f"{p}_sub" for p in aqi.SCALES]
    top = f"greatest({', '.join(subs)})"
    whens = " ".join(f"when {p}_sub = {top} then '{p}'" for p in aqi.SCALES)
    return (f"select station_id, ts, h, city, {', '.join(SENSORS)}, {top} as aqi, "
            f"case {whens} end as dominant_pollutant from indexed")


def _windowed():
    cols = [f"{lag_sql('aqi', h)} as aqi_lag_{h}h" for h in LAGS]
    for name, hours, least in ROLLING:
        cols.append(f"{roll_sql('avg', 'aqi', hours, least)} as aqi_roll_mean_{name}")
        cols.append(f"{std_sql('aqi', hours, least)} as aqi_roll_std_{name}")
    cols += [f"{roll_sql(f, 'aqi', 24, 6)} as aqi_roll_{f}_1d" for f in ("max", "min")]
    for p in POLLUTANT_WINDOWS:
        cols.append(f"{lag_sql(p, 24)} as {p}_lag_24h")
        cols.append(f"{units_sql('avg', p, 24, 6)} as {p}_roll_24h")
    cols.append(f"pressure - {lag_sql('pressure', 24)} as pressure_trend_24h")
    cols.append(f"{roll_sql('max', 'temperature', 24, 6)} - "
                f"{roll_sql('min', 'temperature', 24, 6)} as temp_range_24h")
    cols.append(f"{units_sql('sum', 'precipitation', 24, 6)} as precip_24h")
    cols.append(f"{units_sql('sum', 'precipitation', 72, 12)} as precip_72h")
    cols += [f"{units_sql('avg', c, 24, 6)} as {c}_roll_24h" for c in WEATHER_MEANS]
    return "select *, " + ", ".join(cols) + " from hourly"


def _featured():
    month = "month(ts)"
    cols = ["hour(ts) as hour", "day(ts) as day", f"{month} as month",
            "isodow(ts) - 1 as day_of_week",
            "case when isodow(ts) >= 6 then 1 else 0 end as is_weekend",
            "sin(2 * pi() * hour(ts) / 24) as hour_sin",
            "cos(2 * pi() * hour(ts) / 24) as hour_cos",
            f"sin(2 * pi() * {month} / 12) as month_sin",
            f"cos(2 * pi() * {month} / 12) as month_cos"]
    cols += [f"case when {month} in ({', '.join(map(str, m))}) then 1 else 0 end as season_{s}"
             for s, m in SEASONS.items()]
    cols += ["aqi_roll_max_1d - aqi_roll_min_1d as aqi_range_1d",
             *[f"aqi - aqi_lag_{h}h as aqi_trend_{h}h" for h in TRENDS],
             "aqi - aqi_roll_mean_7d as aqi_vs_7d",
             "-wind_speed * sin(radians(wind_deg)) as wind_u",
             "-wind_speed * cos(radians(wind_deg)) as wind_v",
             "wind_speed * (100.0::double - humidity) / 100.0::double as ventilation",
             "case when wind_speed < 1.5 then 1 else 0 end as calm_flag"]
    return "select *, " + ", ".join(cols) + " from windowed"


def _features():
    return (f"select station_id, ts, city, dominant_pollutant, {', '.join(FEATURES)} "
            "from featured where aqi is not null and aqi_lag_168h is not null "
            "and aqi_roll_mean_7d is not null")


def _complete():
    return "select * from features where " + " and ".join(f"{c} is not null" for c in FEATURES)


def stages() -> dict[str, str]:
    feeds = feed_sql("duck")
    return {
        **feeds,
        "poll": _newest_per_hour("pollutants_raw", POLLUTANTS, ", city"),
        "wx": _newest_per_hour("weather_raw", WEATHER),
        "merged": "select p.station_id, p.ts, p.city, "
                  + ", ".join(f"p.{c}" for c in POLLUTANTS) + ", "
                  + ", ".join(f"w.{c}" for c in WEATHER)
                  + " from poll p join wx w on p.station_id = w.station_id and p.ts = w.ts",
        "hours": "select station_id, unnest(generate_series(min(ts), max(ts), "
                 "interval 1 hour)) as ts from merged group by station_id",
        "grid": "select g.station_id, g.ts, (epoch(g.ts) / 3600)::bigint as h, m.city, "
                + ", ".join(f"m.{c}" for c in SENSORS)
                + " from hours g left join merged m on g.station_id = m.station_id "
                "and g.ts = m.ts",
        "seen": _seen(),
        "filled": _filled(),
        "averaged": _averaged(),
        "indexed": _indexed(),
        "hourly": _hourly(),
        "windowed": _windowed(),
        "featured": _featured(),
        "features": _features(),
        "complete": _complete(),
    }


def pipeline(select: str, upto: str = "complete", extra: dict[str, str] | None = None) -> str:
    """``select`` with every stage up to ``upto`` (and ``extra`` ones) defined ahead of it."""
    chosen = {}
    for name, text in stages().items():
        chosen[name] = text
        if name == upto:
            break
    chosen |= extra or {}
    return "with " + ",\n".join(f"{n} as ({t})" for n, t in chosen.items()) + "\n" + select
