"""Time the headline jobs and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data and
the number of local threads. Every job runs to a sink that discards its rows; tables a job
reads are written beforehand, as the stages do in production.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hazegrid.catalog.queries import all_queries, tables_of  # noqa: E402
from hazegrid.operators import backtest, forecast, frame, models  # noqa: E402
from hazegrid.operators.chunks import KEY  # noqa: E402
from hazegrid.plans import features as plan  # noqa: E402
from hazegrid.session import configure  # noqa: E402
from hazegrid.sources import fixtures  # noqa: E402

REPORTS = ["coverage", "gap_report", "null_report", "describe", "aqi_summary", "band_share",
           "dominant_by_month", "daily_timeline", "decile_response", "corr_matrix",
           "autocorrelation", "index_before_after", "metrics_persistence", "r2_by_hour", "swing",
           "select_model", "daily_summary", "history_cards", "top_drivers", "upsert_keep_last",
           "snapshot_document"]


#: Numbers of stations to forecast for, made of copies of the stations at hand.
STATIONS = [1500, 15000]


def many_stations(table: DataFrame, stations: int) -> DataFrame:
    """Model input of 72 hours for copies of each station's newest complete row."""
    latest = forecast.latest_complete(table)
    copies = -(-stations // max(1, latest.count()))
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    rows = latest.withColumn("_copy", copy).withColumn(
        KEY, F.col(KEY) * copies + F.col("_copy")).drop("_copy").limit(stations)
    return forecast.model_input(forecast.expand_leads(rows))


def drained(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench")
                      .config("spark.sql.shuffle.partitions", cpus)
                      .config("spark.driver.memory", "12g")
                      .config("spark.ui.showConsoleProgress", "false")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    t = tables_of(spark, folder)
    queries = all_queries()
    seconds: dict[str, float] = {}

    def timed(name, job):
        start = time.time()
        job()
        seconds[name] = round(time.time() - start, 3)

    # compiles the code that the first job would otherwise pay for
    drained(fixtures.merged(spark, folder).limit(1000))
    timed("merge_sources", lambda: drained(fixtures.merged(spark, folder)))
    t.merged  # noqa: B018  (written once, read by the jobs below)
    timed("hourly_index",
          lambda: drained(plan.hourly_index(t.merged)))
    timed("feature_table",
          lambda: drained(plan.build_features(t.merged)))
    t.hourly, t.features  # noqa: B018
    examples = frame.training_frame(t.features, 1, 24)
    timed("training_frame", lambda: drained(examples))
    fitted = []
    timed("ridge_fit", lambda: fitted.append(models.ridge_block(t.features, 1)))
    timed("ridge_score", lambda: drained(models.predict_level(fitted[0], examples, False)))
    timed("rolling_origin", lambda: drained(backtest.rolling_origin(t.features)))
    for stations in STATIONS:
        ahead = many_stations(t.features, stations)
        timed(f"forecast_{stations}_stations",
              lambda ahead=ahead: drained(forecast.finish(fitted[0].transform(ahead))))
    timed("forecast", lambda: drained(forecast.persistence_forecast(t.features)))
    for name in REPORTS:
        timed(name, lambda name=name: drained(queries[name](spark, folder)))

    grid = t.hourly.count()
    rates = {"grid_rows": grid, "feature_rows_per_sec": round(grid / seconds["feature_table"]),
             "examples_per_sec": round(examples.count() / seconds["training_frame"]),
             "scored_per_sec": round(examples.count() / seconds["ridge_score"]),
             **{f"station_hours_per_sec_{n}": round(n * 72 / seconds[f"forecast_{n}_stations"])
                for n in STATIONS}}
    print(json.dumps({"metric": "total_time", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": Path(folder).name, **rates}))
    spark.stop()


if __name__ == "__main__":
    main()
