"""Registered queries next to their SQL on the smallest data."""

import duckdb
import pytest
from compare import TABLES, differences

import __spark_entry__ as entry
from hazegrid.catalog import queries, streams
from hazegrid.catalog.queries import ROUNDED, Tables, _plain
from hazegrid.schemas import FEATURES

FAST = ["flatten_readings", "flatten_weather", "upsert_keep_last", "merge_sources", "sub_index",
        "coverage", "gap_report", "aqi_hourly", "interpolated", "feature_table", "context_slice",
        "describe", "dominant_by_month", "corr_matrix", "training_frame", "metrics_persistence",
        "compare_models", "forecast_persistence", "daily_summary", "top_drivers",
        "extended_features", "sparkline", "snapshot_readback", "stream_join", "model_features",
        "normalised_names", "optional_columns", "explanation_contents"]


@pytest.fixture(scope="module")
def sql(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, data, sql, name):
    ours = entry.queries()[name](spark, data).toPandas()
    theirs = sql.execute(entry.oracle_sql()[name]).df()
    assert differences(ours, theirs) == []


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["forest_scores", "boosted_delta_scores", "tree_attribution"])
def test_tree_models_are_fitted_on_every_block(spark, data, name):
    rows = entry.queries()[name](spark, data).collect()
    assert {r["block"] for r in rows} == {1, 2, 3}
    if name == "tree_attribution":
        assert {(r["block"], r["hours_ahead"]) for r in rows} == {(1, 12), (2, 36), (3, 60)}


def test_ridge_forecast_shows_its_values(spark, data):
    rows = entry.queries()["forecast_ridge"](spark, data).toPandas()
    assert {"aqi", "category", "colour"} <= set(rows.columns) and rows["aqi"].between(0, 500).all()
    per = rows.groupby("station_id")["hours_ahead"]
    assert len(rows) and (per.nunique() == 72).all() and (per.count() == 72).all()
    assert rows["aqi"].nunique() > 10


@pytest.fixture(scope="module")
def fresh(spark, data):
    return Tables(spark, data)


@pytest.mark.parametrize("name", ["staleness", "wind_rose", "profile_hour", "history_cards", "feature_labels",
                                  "complete_rows", "stream_alerts", "r2_by_hour", "naive_baselines",
                                  "latest_model_version", "list_model_versions"])
def test_reports_do_not_write_every_feature(fresh, sql, name):
    found = getattr(streams if name.startswith("stream_") else queries, name)(fresh)
    assert "features" not in fresh.__dict__
    assert differences(_plain(found).toPandas(), sql.execute(entry.oracle_sql()[name]).df()) == []


def test_narrow_columns_equal_the_whole_table(spark, data):
    t = Tables(spark, data)
    names = [c for c in FEATURES if c not in ROUNDED]
    each = [t.reading(*part) for part in (["city", *names[::2]], ["wind_u", "calm_flag"], ["dominant_pollutant"])]
    wide = t.features
    for narrow in each:
        same = wide.select(narrow.columns)
        assert narrow.count() == same.count() > 0 and narrow.exceptAll(same).isEmpty()
