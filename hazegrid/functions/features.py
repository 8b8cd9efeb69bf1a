"""Row-wise features: calendar parts, wind components, dispersion, lead time."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazegrid.schemas import LEAD_INTERACTIONS

# --- fixed values: months of each season, and the calm-air threshold ---
SEASONS = {
    "winter": (12, 1, 2),
    "summer": (3, 4, 5),
    "monsoon": (6, 7, 8, 9),
    "post_monsoon": (10, 11),
}
CALM_BELOW = 1.5
SECTOR_DEGREES = 22.5


def epoch_hour(ts) -> Column:
    """Hours since the epoch, the integer time axis of every window."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_timestamp(ts) / F.lit(3600)).cast("long")


def hour_start(hour) -> Column:
    hour = F.col(hour) if isinstance(hour, str) else hour
    return F.timestamp_seconds(hour * F.lit(3600))


def calendar(ts: str = "ts") -> dict[str, Column]:
    def wave(fn, part, period):
        return f"{fn}({2.0 * math.pi!r}D * cast({part}({ts}) as double) / {float(period)}D)"

    text = {
        "hour": f"hour({ts})",
        "day": f"dayofmonth({ts})",
        "month": f"month({ts})",
        "day_of_week": f"weekday({ts})",
        "is_weekend": f"cast(weekday({ts}) >= 5 as int)",
        "hour_sin": wave("sin", "hour", 24),
        "hour_cos": wave("cos", "hour", 24),
        "month_sin": wave("sin", "month", 12),
        "month_cos": wave("cos", "month", 12),
    }
    for season, months in SEASONS.items():
        text[f"season_{season}"] = (
            f"cast(month({ts}) in ({', '.join(map(str, months))}) as int)")
    return {name: F.expr(t) for name, t in text.items()}


def weather() -> dict[str, Column]:
    """Features of the current hour's weather alone.

    ``calm_flag`` treats missing wind as not calm. Its threshold is in whatever unit
    the feed delivers wind speed in.
    """
    return {name: F.expr(t) for name, t in {
        "wind_u": "-wind_speed * sin(radians(wind_deg))",
        "wind_v": "-wind_speed * cos(radians(wind_deg))",
        "ventilation": "wind_speed * (100D - humidity) / 100D",
        "calm_flag": f"cast(coalesce(wind_speed < {CALM_BELOW}D, false) as int)",
    }.items()}


def lead_time(hours_ahead: str = "hours_ahead") -> dict[str, Column]:
    names = ["sqrt_hours_ahead", *[f"{c}_x_hours" for c in LEAD_INTERACTIONS]]
    return {name: model_column(name, hours_ahead) for name in names}


def model_column(name: str, hours_ahead: str = "hours_ahead") -> Column:
    """The input called ``name`` in a model's manifest, as an expression."""
    lead = f"cast({hours_ahead} as double)"
    if name == "sqrt_hours_ahead":
        return F.expr(f"sqrt({lead})")
    if name.endswith("_x_hours"):
        return F.expr(f"cast({name.removesuffix('_x_hours')} as double) * {lead}")
    return F.expr(f"cast({name} as double)")


def extended_ratios() -> dict[str, Column]:
    tiny = F.lit(1e-6)
    return {
        "hour_x_weekend": F.col("hour_sin") * F.col("is_weekend"),
        "pm_ratio": F.col("pm2_5") / (F.col("pm10") + tiny),
        "co_no2_ratio": F.col("co") / (F.col("no2") + tiny),
    }


def direction(trend) -> Column:
    return F.when(trend < 0, F.lit("↓")).when(trend > 0, F.lit("↑")).otherwise(F.lit("→"))


def air(humidity) -> Column:
    return F.when(humidity < 50, F.lit("Dry")).otherwise(F.lit("Humid"))


def display(value, decimals: int = 0) -> Column:
    """Half-even rounding for presentation."""
    if decimals == 0:
        return F.rint(value).cast("long")
    unit = float(10 ** decimals)
    return F.rint(value * unit) / unit
