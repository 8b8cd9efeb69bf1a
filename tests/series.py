"""Small irregular series for the tests."""

import numpy as np
import pandas as pd

from hazegrid.schemas import SENSORS

START = pd.Timestamp("2021-01-01")


def readings(hours=600, stations=(1,), seed=0, present=0.8, known=0.8, outage=None):
    """Merged readings: some hours missing, some sensors missing, values in quarters."""
    rng = np.random.default_rng(seed)
    frames = []
    for s in stations:
        at = np.flatnonzero(rng.random(hours) < present)
        if outage:
            at = at[(at < outage[0]) | (at >= outage[1])]
        df = pd.DataFrame({"station_id": s, "ts": START + pd.to_timedelta(at, unit="h"),
                           "city": f"city {s}"})
        for c in SENSORS:
            level = np.cumsum(rng.integers(-6, 7, len(at))) % 400
            values = level / 4.0 + (980.0 if c == "pressure" else 0.0)
            df[c] = np.where(rng.random(len(at)) < known, values, np.nan)
        frames.append(df)
    return pd.concat(frames, ignore_index=True)


def to_spark(spark, df):
    """NaN in the frame becomes NULL."""
    from pyspark.sql import functions as F
    out = spark.createDataFrame(df)
    return out.select(*[F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
                        if f.dataType.typeName() == "double" else F.col(f.name)
                        for f in out.schema.fields])


def sorted_pandas(df, keys=("station_id", "ts")):
    return df.toPandas().sort_values(list(keys)).reset_index(drop=True)
