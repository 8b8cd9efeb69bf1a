"""Station feeds derived from the given tables, in portable arithmetic.

Every ``lineitem`` row is one pollutant reading and one weather reading of a station
(five suppliers each); ship days since 1995 play the hours of a series that starts in
2021. Sensor values are multiples of a quarter, so sums over any window are exact and
two engines can be compared value by value. ``READINGS`` is a template because the
engines spell integer division and adding hours differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazegrid.schemas import POLLUTANTS, WEATHER
from hazegrid.session import prepare

_BASE = """
select {div}(l_suppkey, 5) as station_id, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_quantity, l_discount, l_tax, l_returnflag,
       cast({days} as bigint) as d,
       cast(floor(l_extendedprice * 100 + 0.5) as bigint) as c
from lineitem
"""

_POLLUTANTS = """
select station_id, {hours_minutes} as ts, 'city ' || station_id as city,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, c,
       case when l_discount = 0.0 then null
            else ((c % 400) * (1 + {div}(d, 60) % 5)) / 4.0 end as pm2_5,
       case when l_tax = 0.0 and l_discount > 0.04 then -9999.0
            else (({div}(c, 7) % 500) * (1 + {div}(d, 90) % 4)) / 4.0 end as pm10,
       case when l_tax = 0.01 and l_discount < 0.03 then -9999.0
            else ({div}(c, 11) % 320) / 4.0 end as no2,
       case when l_tax = 0.0 then -9999.0
            else (({div}(c, 13) % 480) * (1 + {div}(d, 40) % 3)) / 4.0 end as o3,
       case when l_discount = 0.1 then null
            else (({div}(c, 17) % 20000) * (1 + {div}(d, 75) % 6)) / 4.0 end as co,
       ({div}(c, 19) % 200) / 4.0 as so2,
       ({div}(c, 23) % 160) / 4.0 as nh3
from base
"""

_WEATHER = """
select station_id, {late_hours_minutes} as ts,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, c,
       10.0 + ({div}(c, 3) % 120) / 4.0 as temperature,
       l_quantity * 2.0 as humidity,
       case when l_discount = 0.02 then null else 990.0 + (c % 160) / 4.0 end as pressure,
       case when l_tax = 0.03 then null else ({div}(c, 5) % 60) / 4.0 end as wind_speed,
       ((l_partkey * 37) % 361) * 1.0 as wind_deg,
       ({div}(c, 29) % 101) * 1.0 as clouds,
       case when l_returnflag = 'R' then ({div}(c, 31) % 40) / 4.0 else 0.0 end as precipitation,
       case when l_discount = 0.05 then null
            else ({div}(c, 37) % 2000) * 1.0 end as boundary_layer_height
from base
"""

ARRIVAL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c"]


class _Div:
    """Formats ``{div}(a, b)`` as integer division in either dialect."""

    def __init__(self, infix: str):
        self.infix = infix

    def apply(self, text: str) -> str:
        import re
        return re.sub(r"\{div\}\(([^,()]+), (\d+)\)", rf"(\1 {self.infix} \2)", text)


_SPARK = {
    "days": "datediff(l_shipdate, date '1995-01-01')",
    "hours_minutes": "timestampadd(minute, l_linenumber * 7, "
                     "timestampadd(hour, d, timestamp '2021-01-01 00:00:00'))",
    "late_hours_minutes": "timestampadd(minute, l_linenumber * 5, "
                          "timestampadd(hour, d + l_linenumber, timestamp '2021-01-01 00:00:00'))",
}
_DUCK = {
    "days": "date_diff('day', date '1995-01-01', cast(l_shipdate as date))",
    "hours_minutes": "timestamp '2021-01-01 00:00:00' + to_hours(d) "
                     "+ to_minutes(l_linenumber * 7)",
    "late_hours_minutes": "timestamp '2021-01-01 00:00:00' + to_hours(d + l_linenumber) "
                          "+ to_minutes(l_linenumber * 5)",
}


def _render(text: str, dialect: str) -> str:
    names = _SPARK if dialect == "spark" else _DUCK
    text = _Div("div" if dialect == "spark" else "//").apply(text)
    for name, value in names.items():
        text = text.replace("{" + name + "}", value)
    return text.strip()


def feed_sql(dialect: str) -> dict[str, str]:
    """The three fixture queries by name: ``base``, ``pollutants_raw``, ``weather_raw``."""
    return {"base": _render(_BASE, dialect),
            "pollutants_raw": _render(_POLLUTANTS, dialect),
            "weather_raw": _render(_WEATHER, dialect)}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; zone-less timestamps are taken as UTC."""
    df = prepare(spark).read.parquet(f"{folder}/{name}.parquet")
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name)
                       if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name)
                       for f in df.schema.fields])


def _feed(spark: SparkSession, folder: str, which: str) -> DataFrame:
    text = feed_sql("spark")
    return spark.sql(f"with base as ({text['base'].replace('from lineitem', 'from {lineitem}')})"
                     f" {text[which]}", lineitem=table(spark, folder, "lineitem"))


def _typed(df: DataFrame, doubles) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in doubles})


def raw_pollutants(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(_feed(spark, folder, "pollutants_raw"), POLLUTANTS)


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(_feed(spark, folder, "weather_raw"), WEATHER + ["boundary_layer_height"])


def merged(spark: SparkSession, folder: str) -> DataFrame:
    from hazegrid.sources.feeds import merge_sources
    return merge_sources(raw_pollutants(spark, folder), raw_weather(spark, folder), ARRIVAL)
