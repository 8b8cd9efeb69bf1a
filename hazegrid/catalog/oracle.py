"""The queries' results in plain SQL over the given tables."""

from __future__ import annotations

from hazegrid.catalog import queries as q
from hazegrid.catalog.stages import (NEWEST, _filled, category_sql, lag_sql, pipeline, roll_sql,
                                     std_sql, sub_index_sql)
from hazegrid.functions import index as aqi
from hazegrid.functions.labels import LABELS, dashboard_labels
from hazegrid.operators import explore
from hazegrid.operators import windows as win
from hazegrid.schemas import (AVERAGING, EXPLAIN_ROWS, FEATURES, LAGS, LEAD_INTERACTIONS, MODEL_INPUTS,
                              POLLUTANT_WINDOWS, POLLUTANTS, ROLLING, SENSORS, TOP_DRIVERS, TRENDS, WEATHER,
                              WEATHER_MEANS, WEATHER_VARIABLES)
from hazegrid.sources.fixtures import ARRIVAL
from hazegrid.sources.snapshot import SHOWN

KEY = "station_id"
ARRIVED = ", ".join(ARRIVAL)

_EVENTS = {"ev": (
    "select event_id, ts, event_type, cast(round(value * 100) as bigint) as cents, "
    "cast(floor(epoch(ts)) as bigint) as seconds, "
    "cast(json_extract_string(props, '$.k') as bigint) as k from events")}


def _with(parts: dict, select: str) -> str:
    return "with " + ",\n".join(f"{n} as ({t})" for n, t in parts.items()) + "\n" + select


def _r(expr, n, name=None):
    return f"round({expr}, {n}) as {name or expr}"


def _cols(names):
    return ", ".join(names)


def _forecast_parts():
    leads = "(select unnest(range(1, 73)) as hours_ahead)"
    return {
        "latest": "select * from (select *, row_number() over (partition by station_id "
                  "order by ts desc) as rn from complete) where rn = 1",
        "ahead": "select station_id, hours_ahead::int as hours_ahead, "
                 "ts + to_hours(hours_ahead) as ts, "
                 "case when hours_ahead <= 24 then 1 when hours_ahead <= 48 then 2 else 3 end "
                 "as day, round_even(least(greatest(aqi, 0), 700), 0)::bigint as aqi "
                 f"from latest, {leads}",
        "forecast": f"select *, {category_sql('aqi')} as category, "
                    f"{category_sql('aqi', 3)} as colour from ahead",
    }


def _daily():
    return {"daily": (
        "select station_id, day, min(ts)::date::timestamp as date, "
        "round_even(avg(aqi), 0)::bigint as mean_aqi, "
        "min(aqi) as min_aqi, max(aqi) as max_aqi, "
        "arg_max(ts, aqi * 1000 - hours_ahead) as worst_hour from forecast "
        "group by station_id, day")}


def _examples(mode="time"):
    """Examples of all leads; ``numbered`` counts table rows."""
    at = "h" if mode == "time" else "row_nr"
    whole = " and ".join(f"c.{c} is not null" for c in FEATURES)
    return {
        "numbered": "select *, (epoch(ts) / 3600)::bigint as h, "
                    "row_number() over (partition by station_id order by ts) - 1 as row_nr, "
                    "count(*) over (partition by station_id) as row_count from features",
        "leads": "select unnest(range(1, 73))::bigint as hours_ahead",
        "spread": f"select c.*, l.hours_ahead from numbered c, leads l where {whole}",
        "examples": "select s.*, f.aqi as y, case when s.hours_ahead <= 24 then 1 "
                    "when s.hours_ahead <= 48 then 2 else 3 end as block from spread s "
                    f"join numbered f on s.station_id = f.station_id "
                    f"and f.{at} = s.{at} + s.hours_ahead",
        "test": "select * from examples where row_nr >= floor(row_count * 0.8)",
    }


def _measure(groups, source, clip=True):
    p = "least(greatest(predicted, 0.0), 700.0)" if clip else "predicted"
    e = f"({p} - actual)"
    return (f"select {groups}, count(*) as examples, sqrt(sum({e} * {e}) / count(*)) as rmse, "
            f"sum(abs({e})) / count(*) as mae, 1.0 - sum({e} * {e}) / (sum(actual * actual) "
            f"- sum(actual) * sum(actual) / count(*)) as r2, "
            f"stddev_pop(predicted) as prediction_spread from {source} group by {groups}")


def _long_inputs():
    """Examples with every model input as a row of its own."""
    def value(name):
        if name == "hours_ahead":
            return "hours_ahead::double"
        if name == "sqrt_hours_ahead":
            return "sqrt(hours_ahead::double)"
        if name.endswith("_x_hours"):
            return f"{name.removesuffix('_x_hours')}::double * hours_ahead"
        return f"{name}::double"

    names = ", ".join(repr(c) for c in MODEL_INPUTS)
    values = ", ".join(value(c) for c in MODEL_INPUTS)
    return {"long_inputs": "select block, case when row_nr >= floor(row_count * 0.8) then 'test' "
            f"else 'train' end as split, y::double as y, unnest([{names}]) as input, "
            f"unnest([{values}]) as x from examples"}


def _origins():
    """Baselines' errors by month, and how many examples were known when it began."""
    guess = {"Persistence": "aqi", "3-day mean": "aqi_roll_mean_3d", "Same hour yesterday": "aqi_lag_24h"}
    names, values = ", ".join(f"'{n}'" for n in guess), ", ".join(f"{c}::double" for c in guess.values())
    return {
        "guesses": "select block::int as block, date_trunc('month', ts)::timestamp as origin, y::double as y, "
                   f"unnest([{names}]) as model, unnest([{values}]) - y as e from examples",
        "ready": "select block::int as block, date_trunc('month', ts + to_hours(hours_ahead::int))::timestamp "
                 "as month, count(*) as n from examples group by 1, 2",
        "known": "select o.block, o.origin, sum(r.n)::bigint as known from (select distinct block, origin "
                 "from guesses) o join ready r on r.block = o.block and r.month < o.origin group by 1, 2",
    }


def _naive():
    guesses = {"Persistence": "aqi", "3-day mean": "aqi_roll_mean_3d",
               "Same hour yesterday": "aqi_lag_24h"}
    union = " union all ".join(
        f"select block, '{n}' as model, y as actual, {c} as predicted from test"
        for n, c in guesses.items())
    return {"naive_rows": union, "naive": _measure("block, model", "naive_rows")}


def _delta():
    guesses = {"Persistence": "aqi", "Trend goes on": "aqi + aqi_trend_24h * 0.25",
               "Back to the week": "aqi + aqi_vs_7d * -0.5"}
    union = " union all ".join(
        f"select block, '{n}' as model, y as actual, {c} as predicted from test"
        for n, c in guesses.items())
    return {"delta_rows": union, "delta": _measure("block, model", "delta_rows")}


def _select(source, name):
    return {
        f"{name}_ranked": f"select *, row_number() over (partition by block order by r2 desc, "
                          f"model) as rank from {source}",
        name: "select block, max(case when rank = 1 then model end) as winner, "
              "max(case when rank = 1 then r2 end) as r2, "
              "max(case when rank = 1 then rmse end) as rmse, "
              "max(case when rank = 1 then mae end) as mae, "
              f"max(case when model = 'Persistence' then r2 end) as baseline_r2 "
              f"from {name}_ranked group by block",
    }


def _weekly():
    return {
        "weekly_rows": "select 'station_' || station_id || '_day' || block as model, "
                       "cast(floor(h / 168) as bigint) as version, y as actual, "
                       "aqi as predicted from examples",
        "weekly": _measure("model, version", "weekly_rows"),
    }


def _quantile(c, p):
    return f"quantile_cont({c}, {p})"


def _profile(part):
    return pipeline(f"select {part}, {_r('avg(aqi)', 6, 'mean')}, "
                    f"{_r('stddev_samp(aqi)', 6, 'std')} from features group by {part}")


def _long(columns, source, keep=""):
    return " union all ".join(f"select {keep}'{c}' as \"column\", {c}::double as value "
                              f"from {source}" for c in columns)


def _decile():
    long = " union all ".join(
        f"select '{c}' as \"column\", aqi, {c}::double as value from features "
        f"where aqi is not null and {c} is not null" for c in explore.RESPONSES)
    marks = ", ".join(str(i / 10) for i in range(11))
    return pipeline(
        f"select b.\"column\", b.bin, {_r('(edges[b.bin] + edges[b.bin + 1]) / 2', 6, 'mid')}, "
        f"{_r('mean_aqi', 6)}, rows, {_r('r', 6)} from bins b join overall o "
        "on b.\"column\" = o.\"column\" where pairs >= 100",
        extra={
            "long": long,
            "edges": "select \"column\", list_sort(list_distinct("
                     f"quantile_cont(value, [{marks}]))) as edges from long group by 1",
            "placed": "select l.*, e.edges, greatest(len(list_filter(e.edges, "
                      "lambda x: x < l.value)), 1)::int as bin from long l join edges e "
                      "on l.\"column\" = e.\"column\"",
            "bins": "select \"column\", bin, any_value(edges) as edges, avg(aqi) as mean_aqi, "
                    "count(*) as rows from placed group by 1, 2",
            "overall": "select \"column\", corr(value, aqi) as r, count(*) as pairs "
                       "from long group by 1"})


def _corr_matrix():
    pairs = [(a, b) for i, a in enumerate(explore.CORRELATED) for b in explore.CORRELATED[i + 1:]]
    rows = " union all ".join(
        f"select '{a}' as left_column, '{b}' as right_column, {_r(f'corr({a}, {b})', 6, 'r')} "
        "from features" for a, b in pairs)
    return pipeline(rows)


def _labels():
    def text(c, table):
        base = f"regexp_replace({c}, '_x_hours$', '')"
        whens = " ".join(f"when '{k}' then '{v}'" for k, v in table.items())
        return (f"case {base} {whens} else replace({base}, '_', ' ') end || "
                f"case when {c} like '%\\_x\\_hours' escape '\\' then ' x lead time' else '' end")

    counts = " union all ".join(f"select '{c}' as \"column\", count({c}) as \"values\" "
                                "from features" for c in FEATURES)
    leads = " union all ".join(f"select '{c}_x_hours', count({c}) from features"
                               for c in ("aqi", "aqi_trend_24h", "aqi_roll_std_1d"))
    label, board = text('"column"', LABELS), text('"column"', dashboard_labels())
    return pipeline(f"select \"column\", \"values\", {label} as label, {board} as "
                    f"dashboard_label from ({counts} union all {leads})")


def _attribution():
    each = " union all ".join(
        f"select station_id, ts, '{c}' as feature, {c}::double as value from recent"
        for c in q.ATTRIBUTED)
    slopes = " union all ".join(
        f"select '{c}' as feature, floor(coalesce(covar_pop({c}::double, aqi) / "
        f"nullif(var_pop({c}::double), 0), 0.0) * 1024) / 1024 as coefficient, "
        f"floor(avg({c}::double) * 64) / 64 as mean from features" for c in q.ATTRIBUTED)
    return {
        "recent": "select * from (select *, row_number() over (partition by station_id "
                  f"order by ts desc) as rn from complete) where rn <= {EXPLAIN_ROWS}",
        "slopes": slopes, "each": each,
        "parts": "select e.*, s.coefficient * (e.value - s.mean) as contribution "
                 "from each e join slopes s on e.feature = s.feature",
    }


def _readings_sql():
    def one(shift):
        return (f"select event_id, make_timestamp((seconds + {shift}) * 1000000) as ts, "
                f"cents::double as pm2_5, (cents * 2 + {shift})::double as pm10, "
                "k::double as no2, case when event_type <> 'error' then (cents * 3)::double end "
                "as o3, null::double as co, (cents + k)::double as so2, "
                "case when event_type <> 'signup' then k::double end as nh3 from ev")
    return _with(_EVENTS, f"{one(0)} union all {one(1800)}")


def _weather_sql():
    def one(minutes, value):
        names = ", ".join(
            "null::double as boundary_layer_height" if n == "boundary_layer_height" else
            f"case when event_type <> 'error' then {value}::double end as clouds"
            if n == "clouds" else f"{value}::double as {n}" for n in WEATHER_VARIABLES.values())
        return (f"select event_id, date_trunc('hour', ts) + to_minutes({minutes}) as ts, "
                f"{names} from ev")
    return _with(_EVENTS, f"{one(0, 'cents')} union all {one(30, 'k')}")


def _per_batch():
    def batch(condition, name):
        clean = ", ".join(f"nullif({c}::double, -9999.0) as {c}" for c in POLLUTANTS)
        return {name: (
            f"select * from (select station_id, date_trunc('hour', ts) as ts, {clean}, "
            f"row_number() over (partition by station_id, date_trunc('hour', ts) order by "
            f"{NEWEST}) as rn from pollutants_raw where {condition}) where rn = 1")}
    both = {**batch("l_linenumber <= 4", "early"), **batch("l_linenumber > 4", "late"),
            "stacked": "select 0 as arrival, * from early union all select 1, * from late"}
    return pipeline(
        f"select station_id, ts, {_cols(POLLUTANTS)} from (select *, row_number() over "
        "(partition by station_id, ts order by arrival desc) as pick from stacked) "
        "where pick = 1", "weather_raw", both)


def _pick(complete):
    better = "candidate_ts > primary_ts" + (
        " and candidate_rows >= primary_rows" if complete else "")
    return pipeline(
        "select coalesce(a.station_id, b.station_id) as station_id, primary_ts, primary_rows, "
        "candidate_ts, candidate_rows, case when primary_ts is null or "
        f"coalesce({better}, false) then 'candidate' else 'primary' end as chosen "
        "from (select station_id, max(ts) as primary_ts, count(*) as primary_rows from poll "
        "group by 1) a full join (select station_id, max(ts) as candidate_ts, "
        "count(*) as candidate_rows from wx group by 1) b on a.station_id = b.station_id", "wx")


_MARKS = {"marks": "select station_id, max(ts) - to_hours("
                   f"{q.BEHIND_HOURS}) as mark from features group by 1"}


def _newest(source, n, columns, condition="true"):
    return (f"select {columns} from (select *, row_number() over (partition by station_id "
            f"order by ts desc) as newest from {source} where {condition}) where newest <= {n}")


def _model_input():
    cols = []
    for n in MODEL_INPUTS:
        if n == "hours_ahead":
            expr = "hours_ahead::double"
        elif n == "sqrt_hours_ahead":
            expr = "sqrt(hours_ahead::double)"
        elif n.endswith("_x_hours"):
            expr = f"{n.removesuffix('_x_hours')}::double * hours_ahead::double"
        else:
            expr = f"{n}::double"
        noisy = ("_sin" in n or "_cos" in n or n in ("wind_u", "wind_v"))
        cols.append(f"round({expr}, 9) as {n}" if noisy else f"{expr} as {n}")
    return pipeline(f"select station_id, ts, {', '.join(cols)} from latest, "
                    "(select unnest(range(1, 73)) as hours_ahead)",
                    extra={"latest": _forecast_parts()["latest"]})


def _ffill():
    def both(c):
        up = ("(partition by station_id order by h rows between unbounded preceding "
              "and current row)")
        down = ("(partition by station_id order by h desc rows between unbounded preceding "
                "and current row)")
        return (f"coalesce(last_value({c} ignore nulls) over {up}, "
                f"last_value({c} ignore nulls) over {down}) as {c}")
    return pipeline(f"select station_id, ts, {both('wind_deg')}, {both('pm2_5')} from grid", "grid")


def _kept(order):
    return pipeline(
        f"select station_id, ts, {ARRIVED}, so2 from (select station_id, date_trunc('hour', ts) "
        f"as ts, {ARRIVED}, so2::double as so2, row_number() over (partition by station_id, "
        f"date_trunc('hour', ts) order by {order}) as rn from pollutants_raw) where rn = 1",
        "pollutants_raw")


def _extended():
    lag = {h: lag_sql("aqi", h) for h in LAGS}
    cols = {
        "aqi_rolling_3d": roll_sql("avg", "aqi", 72, 1),
        "aqi_rolling_7d": roll_sql("avg", "aqi", 168, 1),
        "aqi_rolling_3d_std": std_sql("aqi", 72, 24),
        "aqi_rolling_7d_std": std_sql("aqi", 168, 48),
        "aqi_std_24h": std_sql("aqi", 24, 12),
        "aqi_max_24h": roll_sql("max", "aqi", 24, 12),
        "aqi_min_24h": roll_sql("min", "aqi", 24, 12),
        "aqi_median_24h": roll_sql("median", "aqi", 24, 12),
        "aqi_range_24h": f"({roll_sql('max', 'aqi', 24, 12)}) - ({roll_sql('min', 'aqi', 24, 12)})",
        **{f"aqi_change_{h}h": f"aqi - {lag[h]}" for h in (1, 3, 6, 24)},
        **{f"aqi_lag1_trend_{h}h": f"{lag[1]} - {lag[h]}" for h in (6, 12, 24)},
        **{f"aqi_lag24_trend_{h}h": f"{lag[24]} - {lag[h]}" for h in (48, 72)},
        **{f"{c}_lag24": lag_sql(c, 24) for c in win.EXTENDED_WEATHER},
        **{f"{c}_diff24": f"{c} - {lag_sql(c, 24)}" for c in win.EXTENDED_WEATHER},
        **{f"persistence_{h}h": roll_sql("avg", "aqi", 168, 1) for h in (24, 48, 72)},
        "hour_x_weekend": "round(sin(2 * pi() * hour(ts) / 24) * case when isodow(ts) >= 6 "
                          "then 1 else 0 end, 6)",
        "pm_ratio": "round(pm2_5 / (pm10 + 1e-6::double), 6)",
        "co_no2_ratio": "round(co / (no2 + 1e-6::double), 6)",
    }
    return pipeline("select station_id, ts, " + ", ".join(f"{e} as {n}" for n, e in cols.items())
                    + " from hourly", "hourly")


def _sparkline():
    each = " union all ".join(
        f"select station_id, ts, '{p}' as pollutant, "
        f"round_even(coalesce({p}, 0.0), 1) as value from newest48" for p in SHOWN)
    return pipeline(
        "select station_id, pollutant, (row_number() over w - 1)::int as position, "
        "round(value, 1) as value, round((value - min(value) over all_w) / "
        "greatest(max(value) over all_w - min(value) over all_w, 1e-6), 6) as scaled "
        "from each window w as (partition by station_id, pollutant order by ts), "
        "all_w as (partition by station_id, pollutant)",
        extra={"newest48": _newest("features", 48, "*"), "each": each})


def _snapshot():
    parts = _forecast_parts()
    recent = _newest("features", 7, "*")
    return pipeline(
        "select l.station_id, f.predicted_from, round_even(l.aqi, 0)::bigint as aqi, "
        f"{category_sql('l.aqi')} as category, coalesce(l.dominant_pollutant, 'unknown') "
        "as dominant_pollutant, round_even(t.trend, 1) as trend_6h, case when t.trend < 0 "
        "then '↓' when t.trend > 0 then '↑' else '→' end as direction, "
        "round_even(l.temperature, 1) as temperature, "
        "round_even(l.humidity, 0)::bigint as humidity, "
        "case when l.humidity < 50 then 'Dry' else 'Humid' end as air, "
        "round_even(l.wind_speed, 1) as wind_speed, "
        "round_even(l.wind_deg, 0)::bigint as wind_deg, 72::int as forecast_hours, "
        "3::int as days, p.n::int as history_hours, 3::int as served_models "
        "from now l join now_forecast f on l.station_id = f.station_id "
        "join trend t on l.station_id = t.station_id join past p on l.station_id = p.station_id",
        extra={**parts, "recent": recent, "now": _newest("features", 1, "*"),
               "now_forecast": "select station_id, min(ts) - interval 1 hour as predicted_from "
                               "from forecast group by 1",
               "trend": "select station_id, case when count(*) = 7 then arg_max(aqi, ts) "
                        "- arg_min(aqi, ts) else 0.0 end as trend from recent group by 1",
               "past": "select f.station_id, count(*) as n from features f join (select "
                       "station_id, max(ts) as last from features group by 1) e on "
                       "f.station_id = e.station_id where f.ts >= e.last - interval 30 day "
                       "group by 1"})


def _histogram():
    return pipeline(
        "select bin, round(low + bin * ((high - low) / 80), 6) as left_edge, count(*) as hours "
        "from (select low, high, least(floor((aqi - low) / ((high - low) / 80)), 79)::int as bin "
        "from features, (select min(aqi) as low, max(aqi) as high from features) "
        "where aqi is not null) group by bin, low, high")


def _box():
    long = " union all ".join(f"select '{c}' as \"column\", {c} as value from features "
                              f"where {c} is not null" for c in explore.BOXED)
    return pipeline(
        "select l.\"column\", round(q1, 6) as q1, round(median, 6) as median, "
        "round(q3, 6) as q3, min(case when value >= q1 - 1.5 * (q3 - q1) then value end) "
        "as whisker_low, max(case when value <= q3 + 1.5 * (q3 - q1) then value end) "
        "as whisker_high, count(*) filter (where value < q1 - 1.5 * (q3 - q1) or "
        "value > q3 + 1.5 * (q3 - q1)) as outliers from long l join marks m "
        "on l.\"column\" = m.\"column\" group by l.\"column\", q1, median, q3",
        extra={"long": long,
               "marks": "select \"column\", quantile_cont(value, 0.25) as q1, "
                        "quantile_cont(value, 0.5) as median, quantile_cont(value, 0.75) as q3 "
                        "from long group by 1"})


def _before_after():
    subs = {"pm2_5": "pm2_5", "pm10": "pm10", "co": f"co / {aqi.CO_PER_PPM}",
            "o3": f"o3 / {aqi.O3_PER_PPB}"}
    before = "greatest(" + ", ".join(
        sub_index_sql(subs[p], s) for p, s in aqi.SCALES.items()) + ")"

    def one(label, c):
        w = "over (partition by station_id order by h)"
        return (f"select '{label}' as version, count(*) filter (where v = 500) as at_500, "
                "round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std, "
                "round(median(jump), 6) as median_jump, round(avg(jump), 6) as mean_jump, "
                "count(*) filter (where jump > 100) as jumps_over_100, "
                "round(corr(v, later), 6) as corr_24h from (select "
                f"{c} as v, abs({c} - lag({c}) {w}) as jump, lead({c}, 24) {w} as later from ba)")

    return pipeline(f"{one('before', 'old')} union all {one('after', 'aqi')}", "hourly",
                    {"ba": f"select station_id, h, aqi, {before} as old from hourly"})


def _drift():
    return pipeline(
        "select split, count(v) as count, round(avg(v), 6) as mean, "
        "round(stddev_samp(v), 6) as std, min(v) as min, max(v) as max, "
        + ", ".join(f"round(quantile_cont(v, {p}), 6) as q{n}"
                    for n, p in ((25, 0.25), (50, 0.5), (75, 0.75)))
        + " from (select case when row_number() over (partition by station_id order by h) - 1 "
          ">= floor(count(*) over (partition by station_id) * 0.8) then 'test' else 'train' end "
          "as split, v from (select *, lead(aqi, 24) over (partition by station_id order by h) "
          "as v from hourly) where v is not null and aqi is not null) group by split", "hourly")


def oracle_sql() -> dict[str, str]:
    w = "(partition by station_id order by h)"
    feature_cols = ", ".join(
        f"round({c}, 9) as {c}" if ("_sin" in c or "_cos" in c or c in ("wind_u", "wind_v"))
        else c for c in FEATURES)
    sums = ("select station_id, hours_ahead::int as hours_ahead, count(*) as examples, "
            "sum(y) as y_sum, sum(row_nr)::bigint as row_nr_sum, "
            "sum(aqi * hours_ahead) as aqi_x_hours, "
            "sum(aqi_trend_24h * hours_ahead) as trend_24h_x_hours, "
            "sum(aqi_trend_72h * hours_ahead) as trend_72h_x_hours, "
            "round(max(sqrt(hours_ahead)), 9) as sqrt_hours_ahead "
            "from examples group by station_id, hours_ahead")
    forecast = _forecast_parts()
    forecast_cols = "station_id, hours_ahead, ts, day, aqi, category, colour"
    subs = {"pm2_5": "pm2_5", "pm10": "pm10", "co": f"co / {aqi.CO_PER_PPM}",
            "o3": f"o3 / {aqi.O3_PER_PPB}"}
    clean_raw = (f"select {ARRIVED}, station_id, ts, "
                 + ", ".join(f"nullif({c}::double, -9999.0) as {c}" for c in POLLUTANTS)
                 + " from pollutants_raw")
    sub_cols = ", ".join(f"{sub_index_sql(subs[p], s)} as {p}_index"
                         for p, s in aqi.SCALES.items())
    top = "greatest(" + ", ".join(f"{p}_index" for p in aqi.SCALES) + ")"
    tops = " ".join(f"when {p}_index = {top} then '{p}'" for p in aqi.SCALES)
    score_cols = ", ".join(_r(c, 6) for c in ("rmse", "mae", "r2", "prediction_spread"))
    guess = "aqi + aqi_trend_24h * hours_ahead / 72.0"
    value = "(((cents * 7) % 90000) / 100.0 - 5.0)"
    value = f"case when event_type <> 'error' then {value}::double end"
    noisy = ("hour_sin", "hour_cos", "month_sin", "month_cos")

    weather_sums = ", ".join(f"sum({c}::double) as {c}" for c in WEATHER)

    by_lead = {f"{c}_x_hours": f"{c} * hours_ahead" for c in LEAD_INTERACTIONS}
    by_lead |= {"sqrt_hours_ahead": "sqrt(hours_ahead)"}
    inputs = ", ".join(f"sum(floor(({by_lead.get(c, c)}) * 1000 + 0.5::double))::bigint as in_{c}"
                       for c in MODEL_INPUTS if c != "hours_ahead")

    return {
        "training_frame_inputs": pipeline(
            f"select station_id, hours_ahead::int as hours_ahead, {inputs} from examples "
            "group by station_id, hours_ahead", extra=_examples()),
        "flatten_readings": _readings_sql(),
        "flatten_weather": _weather_sql(),
        "clean_sentinel": pipeline(clean_raw, "pollutants_raw"),
        "drop_sentinel": pipeline(
            f"select {ARRIVED}, station_id, ts, pm10::double as pm10, no2::double as no2, "
            "o3::double as o3 from pollutants_raw where coalesce(pm10 <> -9999, true) "
            "and coalesce(no2 <> -9999, true) and coalesce(o3 <> -9999, true)",
            "pollutants_raw"),
        "feature_sink_roundtrip": pipeline(
            "select station_id, count(*) as rows, min(ts) as first_ts, max(ts) as last_ts, "
            "sum(aqi) as aqi_sum, sum(hour)::bigint as hour_sum, "
            "count(*) filter (where dominant_pollutant is null) as unknown "
            "from features group by station_id"),
        "feature_sink_columns": pipeline(
            f"select station_id, ts, city, coalesce(dominant_pollutant, 'unknown') as "
            f"dominant_pollutant, {feature_cols} from features"),
        "high_water_mark": pipeline("select station_id, max(ts) as mark from features group by 1"),
        "verify_table": pipeline(
            f"select count(*) as rows, {len(FEATURES) + 4}::bigint as columns, "
            "min(ts) as first_ts, max(ts) as last_ts from features"),
        "pick_source": _pick(True),
        "pick_source_recency": _pick(False),
        "upsert_keep_last": _per_batch(),
        "backfill_plan": (
            "with spans as (select o_custkey, min(o_orderdate) as start, max(o_orderdate) as stop "
            "from orders group by 1), years as (select *, unnest(generate_series(date_trunc('year', "
            "start)::timestamp, stop, interval 1 year)) as y from spans where start < stop) "
            "select o_custkey, greatest(start, y) as chunk_start, "
            "least(stop, y + interval 1 year) as chunk_stop from years "
            "where greatest(start, y) < least(stop, y + interval 1 year)"),
        "fetch_gap": pipeline(
            "select station_id, mark as fetch_after, "
            f"cast(floor((epoch(timestamp '{q.NOW}') - epoch(mark)) / 3600) as bigint) as gap_hours, "
            f"floor((epoch(timestamp '{q.NOW}') - epoch(mark)) / 3600) < 1 as up_to_date "
            "from marks", extra=_MARKS),
        "latest_model_version": pipeline(
            "select model, version, round(rmse, 6) as rmse, round(mae, 6) as mae, examples from "
            "(select *, row_number() over (partition by model order by version desc) as rn "
            "from weekly) where rn = 1", extra={**_examples(), **_weekly()}),
        "list_model_versions": pipeline(
            "select model, version, round(rmse, 6) as rmse, round(mae, 6) as mae, examples, "
            "(row_number() over (partition by model order by version desc) - 1)::int as newer "
            "from weekly", extra={**_examples(), **_weekly()}),
        "snapshot_document": _snapshot(),
        "snapshot_readback": pipeline(
            "select station_id, hours_ahead, ts, day, aqi, category from forecast",
            extra=forecast),
        "snapshot_daily": pipeline(
            "select station_id, day::int as day, date, mean_aqi, min_aqi, max_aqi, "
            f"{category_sql('mean_aqi')} as category from daily", extra={**forecast, **_daily()}),
        "snapshot_history": pipeline(
            "select f.station_id, f.ts, round_even(f.aqi, 0)::bigint as aqi from features f join "
            "(select station_id, max(ts) as last from features group by 1) e on "
            "f.station_id = e.station_id where f.ts >= e.last - interval 30 day"),
        "snapshot_pollutants": "select station_id, pollutant, position, value from ("
                               + _sparkline() + ")",
        "range_filter": pipeline(
            f"select station_id, ts, city, {_cols(SENSORS)} from merged where ts between "
            "timestamp '2021-02-01' and timestamp '2021-03-01'", "merged"),
        "context_slice": pipeline(
            _newest("before", 200, f"station_id, ts, {_cols(SENSORS)}"),
            extra={**_MARKS, "before": "select f.* from features f join marks m on "
                   "f.station_id = m.station_id where f.ts <= m.mark"}),
        "fresh_rows": pipeline(
            "select f.station_id, f.ts, f.aqi, f.aqi_lag_168h, f.dominant_pollutant "
            "from features f join marks m on f.station_id = m.station_id where f.ts > m.mark",
            extra=_MARKS),
        "complete_rows": pipeline(
            "select station_id, ts, aqi, aqi_roll_std_7d, wind_speed, precip_72h from complete"),
        "model_input": _model_input(),
        "history_30d": pipeline(
            f"select f.station_id, f.ts, f.aqi, {', '.join(f'f.{c}' for c in SHOWN)} "
            "from features f join (select station_id, max(ts) as last from features group by 1) e "
            "on f.station_id = e.station_id where f.ts >= e.last - interval 30 day"),
        "staleness": pipeline(
            "select station_id, mark, age_hours, age_hours > 48 as stale from (select station_id, "
            f"max(ts) as mark, (epoch(timestamp '{q.NOW}') - epoch(max(ts))) / 3600.0::double "
            "as age_hours from features group by 1)"),
        "duplicate_rows": pipeline(
            "select station_id, ts, l_linenumber, (row_number() over (partition by station_id, ts, "
            "l_linenumber))::int as copy from (select *, count(*) over (partition by station_id, "
            "ts, l_linenumber) as copies from (select station_id, date_trunc('hour', ts) as ts, "
            "l_linenumber from pollutants_raw)) where copies > 1", "pollutants_raw"),
        "merge_sources": pipeline(
            f"select station_id, ts, city, {_cols(SENSORS)} from merged", "merged"),
        "hourly_grid_rows": pipeline(
            f"select station_id, ts, {_cols(SENSORS)} from grid", "grid"),
        "sub_index": pipeline(
            f"select *, {top} as aqi, case {tops} end as dominant_pollutant from (select {ARRIVED}, "
            f"station_id, {sub_cols} from cleaned)", "pollutants_raw", {"cleaned": clean_raw}),
        "coverage": pipeline(
            "select *, expected - present as missing, (expected - present) * 100.0::double / "
            "expected as missing_pct from (select station_id, min(ts) as first_ts, max(ts) as "
            "last_ts, ((epoch(max(ts)) - epoch(min(ts))) / 3600)::bigint + 1 as expected, "
            "count(*) as present from merged group by 1)", "merged"),
        "gap_report": pipeline(
            "select station_id, count(*) filter (where gap > 1) as gaps, max(gap) as "
            "largest_gap_hours from (select station_id, ((epoch(ts) - epoch(lag(ts) over "
            "(partition by station_id order by ts))) / 3600)::bigint as gap from merged) "
            "group by 1", "merged"),
        "null_report": pipeline(" union all ".join(
            f"select '{c}' as \"column\", count(*) filter (where {c} is null) as nulls, "
            f"count(*) filter (where {c} is null) * 100.0::double / count(*) as null_pct "
            "from merged" for c in SENSORS), "merged"),
        "dupe_report": pipeline(
            "select sum(n)::bigint as rows, sum(n - 1)::bigint as duplicate_keys, "
            "sum(same)::bigint as duplicate_rows from (select sum(n) as n, sum(n - 1) as same "
            "from (select station_id, date_trunc('hour', ts) as ts, l_linenumber, count(*) as n "
            "from pollutants_raw group by 1, 2, 3) group by station_id, ts)", "pollutants_raw"),
        "sentinel_report": pipeline(" union all ".join(
            f"select '{c}' as \"column\", count(*) filter (where {c} = -9999) as sentinels, "
            f"count(*) filter (where {c} = -9999) * 100.0::double / count(*) as sentinel_pct "
            "from pollutants_raw" for c in POLLUTANTS), "pollutants_raw"),
        "describe": pipeline(" union all ".join(
            f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 6) as mean, "
            f"round(stddev_samp({c}), 6) as std, min({c}) as min, "
            + ", ".join(f"round(quantile_cont({c}, {p}), 6) as q{n}"
                        for n, p in ((25, 0.25), (50, 0.5), (75, 0.75)))
            + f", max({c}) as max from merged" for c in SENSORS), "merged"),
        "aqi_summary": pipeline(
            "select count(*) as rows, round(avg(aqi), 6) as mean, round(median(aqi), 6) as median, "
            "round(stddev_samp(aqi), 6) as std, min(aqi) as min, max(aqi) as max, "
            "round(floor((epoch(max(ts)) - epoch(min(ts))) / 86400) / 365.0::double, 6) as years "
            "from features"),
        "band_share": pipeline(" union all ".join(
            f"select {i}::int as position, '{label}' as band, count(*) filter (where aqi >= {low} "
            f"and aqi < {high}) * 100.0::double / count(*) as share_pct from features"
            for i, (low, high, label) in enumerate(aqi.BANDS))),
        "dominant_share": pipeline(
            "select dominant_pollutant, count(*) as hours, count(*) * 100.0::double / "
            "(select count(*) from features) as share_pct from features "
            "where dominant_pollutant is not null group by 1"),
        "dominant_by_month": pipeline(
            "select month(ts)::int as month, " + ", ".join(
                f"count(*) filter (where dominant_pollutant = '{p}') * 100.0::double / count(*) "
                f"as {p}_pct" for p in aqi.SCALES)
            + " from features where dominant_pollutant is not null group by 1"),
        "daily_timeline": pipeline(
            "select station_id, date, round(daily_aqi, 6) as daily_aqi, "
            "round(case when count(daily_aqi) over d >= 10 then avg(daily_aqi) over d end, 6) as "
            "mean_30d from (select station_id, ts::date::timestamp as date, avg(aqi) as daily_aqi from hourly "
            "group by 1, 2) window d as (partition by station_id order by date rows between 29 "
            "preceding and current row)", "hourly"),
        "profile_hour": _profile("hour"),
        "profile_month": _profile("month"),
        "decile_response": _decile(),
        "wind_rose": pipeline(
            "select floor(wind_deg / 22.5)::int as sector, round(avg(aqi), 6) as mean_aqi, "
            "count(*) as hours from features where wind_deg >= 0 and wind_deg < 360 and "
            "wind_speed is not null and aqi is not null group by 1"),
        "histogram": _histogram(),
        "box_stats": _box(),
        "corr_matrix": _corr_matrix(),
        "target_corr": pipeline(" union all ".join(
            f"select '{c}' as \"column\", round(corr({c}, target_day1), 6) as r from targeted"
            for c in q.TARGET_INPUTS), extra={"targeted": (
                "select f.*, t.target_day1 from features f join (select station_id, ts, "
                f"lead(aqi, 24) over {w} as target_day1 from hourly) t "
                "on f.station_id = t.station_id and f.ts = t.ts")}),
        "autocorrelation": pipeline(
            "select l.lag_hours::int as lag_hours, round(corr(a.aqi, b.aqi), 6) as r, "
            "count(*) as pairs from hourly a, (select unnest(range(1, 73)) as lag_hours) l, "
            "hourly b where a.station_id = b.station_id and b.h = a.h + l.lag_hours and "
            "a.aqi is not null and b.aqi is not null group by 1", "hourly"),
        "metrics_persistence": pipeline(
            f"select block, examples, {score_cols} from scored",
            extra={**_examples(),
                   "rows_": "select block, y as actual, aqi as predicted from test",
                   "scored": _measure("block", "rows_")}),
        "r2_by_hour": pipeline(
            "select block, hours_ahead::int as hours_ahead, examples, round(r2, 6) as r2 from scored "
            "where examples > 30",
            extra={**_examples(),
                   "rows_": "select block, hours_ahead, y as actual, aqi as predicted from test",
                   "scored": _measure("block, hours_ahead", "rows_", clip=False)}),
        "swing": pipeline(
            "select block, round(median(p), 6) as predicted_swing, round(median(a), 6) as "
            "actual_swing from (select block, station_id, row_nr, max(guess) - min(guess) as p, "
            f"max(y) - min(y) as a from (select *, {guess} as guess from test) group by 1, 2, 3) "
            "group by block", extra=_examples()),
        "daily_summary": pipeline(
            f"select station_id, day, date, mean_aqi, min_aqi, max_aqi, "
            f"{category_sql('mean_aqi')} as category, {category_sql('mean_aqi', 3)} as colour, "
            "worst_hour from daily", extra={**forecast, **_daily()}),
        "history_cards": pipeline(
            "select station_id, span_hours::int as span_hours, floor(avg(aqi))::bigint as mean_aqi, "
            "max(aqi) as highest, min(aqi) as lowest, count(*) as readings from numbered_desc, "
            "(select unnest([24, 168, 720]) as span_hours) where n <= span_hours group by 1, 2",
            extra={"numbered_desc": "select *, row_number() over (partition by station_id "
                                    "order by ts desc) as n from features"}),
        "index_before_after": _before_after(),
        "split_drift": _drift(),
        "aqi_hourly": pipeline(
            "select station_id, ts, aqi, dominant_pollutant from hourly", "hourly"),
        "aqi_lags": pipeline(
            f"select station_id, ts, aqi, {_cols(f'aqi_lag_{h}h' for h in LAGS)} from windowed",
            "windowed"),
        "aqi_rolling": pipeline(
            "select station_id, ts, "
            + _cols(f"aqi_roll_{s}_{n}" for n, _, _ in ROLLING for s in ("mean", "std"))
            + ", aqi_roll_max_1d, aqi_roll_min_1d, aqi_range_1d from featured", "featured"),
        "aqi_trends": pipeline(
            f"select station_id, ts, {_cols(f'aqi_trend_{h}h' for h in TRENDS)}, aqi_vs_7d "
            "from featured", "featured"),
        "pollutant_windows": pipeline(
            "select station_id, ts, "
            + _cols(f"{p}_{k}_24h" for p in POLLUTANT_WINDOWS for k in ("lag", "roll"))
            + " from windowed", "windowed"),
        "weather_windows": pipeline(
            "select station_id, ts, pressure_trend_24h, temp_range_24h, precip_24h, precip_72h, "
            + _cols(f"{c}_roll_24h" for c in WEATHER_MEANS) + " from windowed", "windowed"),
        "interpolated": pipeline(
            f"select station_id, ts, city, {_cols(SENSORS)} from filled", "filled"),
        "interpolated_whole_gaps": pipeline(
            f"select station_id, ts, {_cols(SENSORS)} from whole", "seen",
            {"whole": _filled("kp + kn - 1 <= 3")}),
        "ffill_bfill": _ffill(),
        "dedupe_last": _kept(NEWEST),
        "dedupe_first": _kept(ARRIVED),
        "day_targets": pipeline(
            "select station_id, ts, aqi, " + ", ".join(
                f"lead(aqi, {24 * d}) over {w} as target_day{d}" for d in (1, 2, 3))
            + " from hourly", "hourly"),
        "extended_features": _extended(),
        "sparkline": _sparkline(),
        "chrono_split": pipeline(
            "select station_id, ts, row_nr, row_count, case when row_nr >= floor(row_count * 0.8) "
            "then 'test' else 'train' end as split from numbered",
            extra={"numbered": _examples()["numbered"]}),
        "chrono_split_time": pipeline(
            "select station_id, ts, case when (epoch(ts) / 3600)::bigint >= low + "
            "floor((high - low) * 0.8) then 'test' else 'train' end as split from features, "
            "(select (epoch(min(ts)) / 3600)::bigint as low, (epoch(max(ts)) / 3600)::bigint as "
            "high from features)"),
        "latest_complete": pipeline(
            "select station_id, ts, aqi, dominant_pollutant, aqi_lag_168h, aqi_roll_std_7d "
            "from latest", extra={"latest": forecast["latest"]}),
        "recent_sample": pipeline(
            "select station_id, ts, aqi, row_nr, row_count from (select *, row_number() over "
            "(partition by station_id order by ts) - 1 as row_nr, count(*) over (partition by "
            f"station_id) as row_count from complete) where row_nr >= row_count - {EXPLAIN_ROWS}"),
        "select_model": pipeline(
            "select block, winner, " + ", ".join(_r(c, 6) for c in ("r2", "rmse", "mae", "baseline_r2"))
            + ", round(r2 - baseline_r2, 6) as improvement, winner <> 'Persistence' as served "
            "from chosen", extra={**_examples(), **_naive(), **_select("naive", "chosen")}),
        "compare_models": pipeline(
            "select a.block, a.winner as absolute_winner, round(a.r2, 6) as absolute_r2, "
            "round(a.rmse, 6) as absolute_rmse, d.winner as delta_winner, "
            "round(d.r2, 6) as delta_r2, round(d.rmse, 6) as delta_rmse, "
            "case when d.r2 > a.r2 then 'delta' else 'absolute' end as better "
            "from chosen a full join chosen_delta d on a.block = d.block",
            extra={**_examples(), **_naive(), **_delta(), **_select("naive", "chosen"),
                   **_select("delta", "chosen_delta")}),
        "categories": _with(_EVENTS, f"select event_id, value, {category_sql('value')} as category, "
                            f"{category_sql('value', 3)} as colour from (select event_id, {value} "
                            "as value from ev)"),
        "time_features": _with(_EVENTS, "select event_id, hour(ts)::int as hour, day(ts)::int as "
                               "day, month(ts)::int as month, (isodow(ts) - 1)::int as day_of_week, "
                               "(isodow(ts) >= 6)::int as is_weekend, "
                               "round(sin(2 * pi() * hour(ts) / 24), 9) as hour_sin, "
                               "round(cos(2 * pi() * hour(ts) / 24), 9) as hour_cos, "
                               "round(sin(2 * pi() * month(ts) / 12), 9) as month_sin, "
                               "round(cos(2 * pi() * month(ts) / 12), 9) as month_cos, "
                               "(month(ts) in (12, 1, 2))::int as season_winter, "
                               "(month(ts) in (3, 4, 5))::int as season_summer, "
                               "(month(ts) in (6, 7, 8, 9))::int as season_monsoon, "
                               "(month(ts) in (10, 11))::int as season_post_monsoon from ev"),
        "weather_features": pipeline(
            "select station_id, ts, round(-wind_speed * sin(radians(wind_deg)), 9) as wind_u, "
            "round(-wind_speed * cos(radians(wind_deg)), 9) as wind_v, "
            "round(wind_speed * (100.0::double - humidity) / 100.0::double, 9) as ventilation, "
            "case when wind_speed < 1.5 then 1 else 0 end::int as calm_flag from merged", "merged"),
        "feature_labels": _labels(),
        "feature_table": pipeline(
            f"select station_id, ts, city, dominant_pollutant, {feature_cols} from features"),
        "training_frame": pipeline(sums, extra=_examples()),
        "training_frame_by_row": pipeline(sums, extra=_examples("row")),
        "delta_target": pipeline(
            "select station_id, block, count(*) as examples, sum(y - aqi) as change_sum, "
            "sum(abs(y - aqi)) as change_size, min(y - aqi) as largest_fall, "
            "max(y - aqi) as largest_rise from examples group by 1, 2", extra=_examples()),
        "naive_baselines": pipeline(
            f"select block, model, examples, {score_cols} from naive",
            extra={**_examples(), **_naive()}),
        "forecast_persistence": pipeline(f"select {forecast_cols} from forecast", extra=forecast),
        "forecast_slices": pipeline(
            f"select {forecast_cols} from forecast where hours_ahead % 6 = 0", extra=forecast),
        "forecast_one_hour": pipeline(
            f"select {forecast_cols} from forecast where hours_ahead = 18", extra=forecast),
        "alerts": pipeline(
            "select station_id, ts, hours_ahead, aqi, category from (select *, row_number() over "
            "(partition by station_id order by aqi desc, hours_ahead) as rn from forecast) "
            "where rn = 1 and aqi >= 150", extra=forecast),
        "stream_collector": pipeline(
            "select station_id, ts, aqi, dominant_pollutant, aqi_lag_168h, aqi_roll_std_7d, "
            "pm2_5, precip_72h from features"),
        "stream_dedupe": "select distinct user_id % 64 as station_id, date_trunc('hour', ts) as ts "
                         "from events",
        "stream_join": _with({**_EVENTS, "hours": (
            "select e.user_id % 64 as station_id, date_trunc('hour', e.ts) as ts, e.event_type, "
            "v.cents from events e join ev v on e.event_id = v.event_id")},
            "select p.station_id, p.ts, p.cents::bigint as poll_cents, w.cents::bigint as wx_cents "
            "from (select station_id, ts, sum(cents) as cents from hours where "
            "event_type <> 'error' group by 1, 2) p join (select station_id, ts, sum(cents) as "
            "cents from hours where event_type = 'error' group by 1, 2) w "
            "on p.station_id = w.station_id and p.ts = w.ts"),
        "stream_averages": pipeline(
            "select station_id, ts, round(avg, 9) as average, n as values from (select station_id, "
            "ts, avg(pm2_5) over d as avg, count(pm2_5) over d as n from hourly window d as "
            "(partition by station_id order by h rows between 23 preceding and current row)) "
            "where n >= 18", "hourly"),
        "stream_panes": pipeline(
            "select station_id, ts, " + ", ".join(
                f"case when count({p}) over w{hours} >= {least} then round(avg({p}) over w{hours}, 9) end "
                f"as {p}_avg" for p, (hours, least) in AVERAGING.items())
            + " from hourly window " + ", ".join(
                f"w{hours} as (partition by station_id order by h rows between {hours - 1} preceding "
                f"and current row)" for hours in sorted({h for h, _ in AVERAGING.values()})), "hourly"),
        "stream_lags": pipeline(
            f"select station_id, ts, aqi, {_cols(f'aqi_lag_{h}h' for h in LAGS)} from windowed",
            "windowed"),
        "stream_alerts": pipeline(
            "select station_id, ts, hours_ahead, aqi, category from forecast where aqi >= 150",
            extra=forecast),
        "block_moments": pipeline(
            "select block, split, input, count(*) as examples, round(avg(x), 4) as mean, "
            "round(avg(x * y), 2) as with_target, round(sqrt(avg(x * x)), 4) as root_square from long_inputs "
            "group by block, split, input", extra={**_examples(), **_long_inputs()}),
        "rolling_origin_baselines": pipeline(
            "select block, origin, model, any_value(known) as trained_on, count(*) as examples, "
            "round(sqrt(avg(e * e)), 6) as rmse, round(1.0 - sum(e * e) / (sum(y * y) - sum(y) * sum(y) "
            "/ count(*)), 6) as r2 from guesses join known using (block, origin) "
            "where known >= 1000 group by block, origin, model",
            extra={**_examples(), **_origins()}),
        "row_floor": pipeline("select n + k as least, k = 0 as accepted, n as rows from "
                              "(select count(*) as n from features), "
                              "(select unnest([0, 1])::bigint as k)", "features"),
        "ridge_optimality": (
            "select block::int as block, feature, 0.0::double as gap from (select unnest([1, 2, 3]) "
            f"as block), (select unnest([{', '.join(repr(c) for c in MODEL_INPUTS)}]) as feature)"),
        "registered_models": (
            "select 'day' || day as model, 1::bigint as version, case when day = 1 then 'delta' "
            "else 'absolute' end as type, 'Ridge' as algorithm, (day * 24 - 23)::int as first_hour, "
            f"(day * 24)::int as last_hour, {len(MODEL_INPUTS)}::int as inputs, "
            f"'{MODEL_INPUTS[0]}' as first_input from (select unnest([1, 2, 3]) as day)"),
        "forecast_registered": pipeline(
            "select station_id, hours_ahead, ts, day, true as in_range, true as category_fits, "
            "true as colour_fits from forecast", extra=forecast),
        "forecast_sink": pipeline(
            "select station_id, hours_ahead, ts, day::int as day, aqi, category, colour "
            "from forecast", extra=forecast),
        "ridge_attribution": pipeline(
            "select station_id, ts, b.block::int as block, (b.block * 24 - 12)::int as hours_ahead, "
            f"{TOP_DRIVERS}::int as shown, 0.0::double as gap from latest, "
            "(select unnest([1, 2, 3]) as block) b", extra=forecast),
        "model_features": pipeline("select unnest([" + ", ".join(
            f"{{'position': {i}::int, 'feature': '{name}', 'present': count({c})}}"
            for i, (name, c) in enumerate([*zip(FEATURES, FEATURES), ("spare_reading", "aqi")]))
            + "], recursive := true) from features"),
        "normalised_names": pipeline(
            f"select station_id, count(ts) as rows, {weather_sums} from weather_raw group by 1",
            "weather_raw"),
        "optional_columns": pipeline(
            f"select feed, {len(SENSORS) + 3}::int as columns, station_id, count(*) as rows, "
            f"{weather_sums} from merged, (select unnest(['with', 'without']) as feed) "
            "group by feed, station_id", "merged"),
        "explanation_document": pipeline(
            "select station_id, ts as explained_from, aqi::bigint as current_aqi, b.day::int as day, "
            "model, (b.day * 24 - 12)::int as hours_ahead, "
            f"{TOP_DRIVERS}::int as important, {TOP_DRIVERS}::int as shown, 0.0::double as gap "
            "from latest, (values (1, 'Ridge (delta)'), (2, 'Ridge'), (3, 'Ridge')) b(day, model)",
            extra=forecast),
        "explanation_contents": pipeline(
            "select station_id, l.ts as explained_from, l.aqi::bigint as current_aqi, list, "
            "rank::int as rank, feature, case feature "
            + " ".join(f"when '{k}' then '{v}'" for k, v in LABELS.items())
            + " else replace(feature, '_', ' ') end as label, round(amount, 3) as amount from "
            "(select *, row_number() over (partition by station_id, list order by abs(amount) desc, "
            "feature) as rank from (select station_id, 'global_importance' as list, feature, "
            "avg(abs(contribution)) as amount from parts group by 1, 3 union all "
            "select station_id, 'current_explanation', feature, contribution from parts "
            "join latest using (station_id, ts))) join latest l using (station_id) "
            f"where rank <= {TOP_DRIVERS}", extra=_attribution() | {"latest": forecast["latest"]}),
        "stream_two_sinks": pipeline(
            "select station_id, count(*) as local_rows, sum(aqi) as local_aqi, "
            "count(*) as served_rows, sum(aqi) as served_aqi from features group by 1"),
        "linear_attribution": pipeline(
            "select station_id, feature, count(*) as rows, round(sum(contribution), 3) as total, "
            "round(max(contribution), 3) as largest, round(min(contribution), 3) as smallest "
            "from parts group by 1, 2", extra=_attribution()),
        "top_drivers": pipeline(
            "select station_id, feature, case feature "
            + " ".join(f"when '{k}' then '{v}'" for k, v in LABELS.items())
            + " else replace(feature, '_', ' ') end as label, rank::int as rank, "
              "round(mean_abs, 3) as mean_abs from (select *, row_number() over (partition by "
              "station_id order by mean_abs desc, feature) as rank from (select station_id, "
              "feature, avg(abs(contribution)) as mean_abs from parts group by 1, 2)) "
              "where rank <= 12", extra=_attribution()),
    }
