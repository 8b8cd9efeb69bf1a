"""Explanations taken from wide rows agree with those from a row per input."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazegrid.operators import explain, forecast
from hazegrid.operators.chunks import last_rows, newest_rows
from hazegrid.plans.features import build_features, complete
from hazegrid.schemas import MODEL_INPUTS
from series import readings, to_spark


@pytest.fixture(scope="module")
def table(spark):
    rows = to_spark(spark, readings(900, stations=(1, 2), seed=8, present=0.95, known=0.97))
    return build_features(rows).cache()


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_rows_without_a_wide_shuffle(table):
    keys, rows = ["station_id", "ts"], complete(table)
    got, want = (sorted(map(tuple, f(rows, 40).select(keys).collect())) for f in (newest_rows, last_rows))
    assert got == want and len(got) == 80
    assert "Exchange hashpartitioning" not in planned(newest_rows(rows, 40)).split("InMemoryRelation")[0]


def test_linear_drivers_equal_those_of_single_contributions(spark, table):
    inputs = ["aqi", "pm10", "hour", "aqi_lag_1h"]
    rows = table.withColumn("pm10", F.when(F.col("hour") > 3, F.col("pm10")))  # some missing, all of one station
    rows = rows.withColumn("pm10", F.when(F.col("station_id") == 1, F.col("pm10")))
    parts = spark.createDataFrame([("aqi", 0.5, 100.0), ("pm10", -2.0, 7.0), ("hour", 0.0, 12.0)],
                                  "feature string, coefficient double, mean double")
    got, want = (df.toPandas().sort_values(["station_id", "rank"]).reset_index(drop=True) for df in (
        explain.linear_drivers(rows, inputs, parts, ["station_id"]),
        explain.top_drivers(explain.linear_attribution(rows, inputs, parts), ["station_id"])))
    pd.testing.assert_frame_equal(got[want.columns], want, rtol=1e-12)


def test_background_means_of_all_leads(table):
    rows = complete(table)
    found = explain.background_means(rows, MODEL_INPUTS, [12, 60])
    for lead in (12, 60):
        at = forecast.model_input(rows.withColumn("hours_ahead", F.lit(lead)))
        want = at.agg(*[F.avg(c).alias(c) for c in MODEL_INPUTS]).first().asDict()
        assert found[lead] == pytest.approx(want, rel=1e-12)


def test_shuffled_files_go_with_their_job(spark, tmp_path):
    """A written table leaves no shuffle files behind, however long the session lives."""
    import time
    from pathlib import Path

    from hazegrid.session import prepare, written

    root = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
                .localDirs()[0].getPath())

    def shuffled():
        return {f.name for f in root.rglob("shuffle_*.data")}

    before, rows = shuffled(), prepare(spark).range(20_000).selectExpr("id % 7000 as k", "id as v")
    out = written(rows.groupBy("k").agg(F.sum("v").alias("v")), "summed")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and out.count() == 7000
