"""The air-quality index as Column expressions.

Breakpoints are a parameter of every function, so another vintage of the standard
only needs another table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scale:
    """One pollutant's table: (low, high, index low, index high) rows."""

    rows: tuple
    decimals: int


# --- fixed values: breakpoints of the standard and the decimals values are cut to ---
PM2_5 = Scale((
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 350.4, 301, 400),
    (350.5, 500.4, 401, 500),
), 1)
PM10 = Scale((
    (0, 54, 0, 50),
    (55, 154, 51, 100),
    (155, 254, 101, 150),
    (255, 354, 151, 200),
    (355, 424, 201, 300),
    (425, 504, 301, 400),
    (505, 604, 401, 500),
), 0)
CO = Scale((
    (0.0, 4.4, 0, 50),
    (4.5, 9.4, 51, 100),
    (9.5, 12.4, 101, 150),
    (12.5, 15.4, 151, 200),
    (15.5, 30.4, 201, 300),
    (30.5, 40.4, 301, 400),
    (40.5, 50.4, 401, 500),
), 1)
O3 = Scale((
    (0, 54, 0, 50),
    (55, 70, 51, 100),
    (71, 85, 101, 150),
    (86, 105, 151, 200),
    (106, 200, 201, 300),
), 0)

# --- fixed values: order in which ties for the dominant pollutant are resolved ---
SCALES = {"pm2_5": PM2_5, "pm10": PM10, "co": CO, "o3": O3}

# --- fixed values: micrograms per cubic metre to ppm (CO) and ppb (O3) ---
CO_PER_PPM = 1145.0
O3_PER_PPB = 1.96

# --- fixed values: categories on the whole-number index, with display colours ---
CATEGORIES = (
    (0, 50, "Good", "#00e400"),
    (51, 100, "Moderate", "#ffff00"),
    (101, 150, "Unhealthy for Sensitive Groups", "#ff7e00"),
    (151, 200, "Unhealthy", "#ff0000"),
    (201, 300, "Very Unhealthy", "#8f3f97"),
    (301, 10000, "Hazardous", "#7e0023"),
)
UNKNOWN = ("Unknown", "#888888")

# --- fixed values: half-open bands used for the share-of-time report ---
BANDS = (
    (0, 50, "Good"),
    (50, 100, "Moderate"),
    (100, 150, "Unhealthy (sensitive)"),
    (150, 200, "Unhealthy"),
    (200, 300, "Very unhealthy"),
    (300, 700, "Hazardous"),
)



# Every rule below is SQL text over a column name or expression. Text reaches the
# planner in one call, where a Column built step by step costs one call per operator,
# and the same text serves DataFrames and SQL functions.


def _number(value) -> str:
    return f"{float(value)!r}D"


def known(value: str) -> str:
    """NaN and NULL both mean missing; keep only NULL."""
    return f"if(isnan(cast({value} as double)), null, cast({value} as double))"


def truncate(value: str, decimals: int) -> str:
    """Cut (floor) to a number of decimals, closing the gaps between brackets."""
    factor = _number(10 ** decimals)
    return f"(cast(floor({value} * {factor}) as double) / {factor})"


def _on_segment(c: str, low, high, index_low, index_high) -> str:
    rise, run = _number(index_high - index_low), f"({_number(high)} - {_number(low)})"
    return f"rint({rise} / {run} * ({c} - {_number(low)}) + {_number(index_low)})"


def sub_index_text(value: str, scale: Scale) -> str:
    """Index of one pollutant, rounded half to even.

    Missing stays missing, below the table is 0, above it the last slope goes on.
    """
    c = truncate(known(value), scale.decimals)
    whens = " ".join(
        f"when {c} between {_number(r[0])} and {_number(r[1])} then {_on_segment(c, *r)}"
        for r in scale.rows)
    return (f"case when {c} is null then cast(null as double) "
            f"when {c} < {_number(scale.rows[0][0])} then 0D {whens} "
            f"else {_on_segment(c, *scale.rows[-1])} end")


def sub_index(value: str, scale: Scale) -> Column:
    return F.expr(sub_index_text(value, scale))


def sub_indices(pm2_5: str | None = None, pm10: str | None = None, co: str | None = None,
                o3: str | None = None, *, co_in_ugm3: bool = True, o3_in_ugm3: bool = True,
                scales=SCALES) -> dict[str, Column]:
    """Sub-index per given pollutant (column name or SQL expression), in tie order."""
    given = {
        "pm2_5": pm2_5,
        "pm10": pm10,
        "co": f"({co}) / {_number(CO_PER_PPM)}" if co and co_in_ugm3 else co,
        "o3": f"({o3}) / {_number(O3_PER_PPB)}" if o3 and o3_in_ugm3 else o3,
    }
    return {p: sub_index(given[p], scale) for p, scale in scales.items() if given.get(p)}


def overall(subs) -> Column:
    """Largest available sub-index of the named columns; missing ones are skipped."""
    return F.expr(_largest(subs))


def _largest(subs) -> str:
    subs = list(subs)
    return f"greatest({', '.join(subs)})" if len(subs) > 1 else subs[0]


def dominant(subs: dict) -> Column:
    """Pollutant that sets the index; ``subs`` maps it to its column, first wins ties."""
    top = _largest(subs.values())
    return F.expr("case " + " ".join(f"when {c} = {top} then '{p}'" for p, c in subs.items())
                  + " end")


def category_text(index: str, part: int = 2) -> str:
    value = f"rint({known(index)})"
    whens = " ".join(f"when {value} between {r[0]} and {r[1]} then '{r[part]}'"
                     for r in CATEGORIES)
    return (f"case when {value} is null then '{UNKNOWN[part - 2]}' {whens} "
            f"else '{CATEGORIES[-1][part]}' end")


def category(index: str) -> Column:
    """Label of an index value, after rounding it half to even."""
    return F.expr(category_text(index))


def colour(index: str) -> Column:
    """Display colour of an index value."""
    return F.expr(category_text(index, 3))


def clip(prediction, bounds) -> Column:
    low, high = bounds
    return F.least(F.greatest(prediction, F.lit(float(low))), F.lit(float(high)))


def register_sql(spark) -> None:
    """Make the index rules available to SQL text as (inlined) SQL functions."""
    bodies = {f"{p}_sub_index": ("double", sub_index_text("c", scale))
              for p, scale in SCALES.items()}
    bodies["aqi_category"] = ("string", category_text("c"))
    bodies["aqi_colour"] = ("string", category_text("c", 3))
    for name, (kind, body) in bodies.items():
        spark.sql(f"create or replace temporary function {name}(c double) "
                  f"returns {kind} return {body}")
