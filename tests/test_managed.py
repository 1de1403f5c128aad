"""Bucketed tables: no exchange on the station, and plain splits where one station fills a bucket."""

from __future__ import annotations

import tempfile
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rivulet.operators import forecast, latest
from rivulet.sources import managed


def make(spark, rows, buckets=4):
    name = f"t_{uuid.uuid4().hex[:12]}"
    managed.create_table(rows, name, buckets=buckets, path=tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t")
    return name


def even(spark):
    return spark.range(4000).select(
        (F.col("id") % 400).cast("string").alias("stn_code"), (2000 + F.col("id") % 7).cast("int").alias("year"),
        (F.col("id") % 100).cast("double").alias("pollution_score"), F.col("id").alias("k1"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def work(kept):
    newest = latest.latest_row(kept)
    return {"latest": newest, "series": forecast.yearly_series(kept, "pollution_score"),
            "compared": newest.join(latest.available_years(kept), "stn_code"),
            "forecast": forecast.forecast_router(kept, horizon=2)}


def test_station_work_needs_no_exchange(spark):
    kept = managed.read_table(spark, make(spark, even(spark)))
    for name, df in work(kept).items():
        assert "hashpartitioning(stn_code" not in plan(df), name
    assert kept.count() == 4000 and not kept.is_cached
    assert "hashpartitioning(stn_code" in plan(latest.latest_row(even(spark)))


def test_same_rows_as_the_plain_table(spark):
    rows = even(spark)
    for name, df in work(managed.read_table(spark, make(spark, rows))).items():
        assert sorted(map(str, df.collect())) == sorted(map(str, work(rows)[name].collect())), name


def test_a_hot_station_is_read_by_plain_splits(spark):
    hot = even(spark).withColumn("stn_code", F.when(F.col("k1") % 3 > 0, "7").otherwise(F.col("stn_code")))
    name = make(spark, hot, buckets=16)
    assert managed.read_table(spark, name, skew=100.0).inputFiles()
    kept = managed.read_table(spark, name)
    assert "Bucketed: true" not in kept._jdf.queryExecution().toString() and kept.columns == hot.columns
    got = latest.latest_row(kept)
    assert "hashpartitioning(stn_code" in plan(got)
    assert sorted(map(str, got.collect())) == sorted(map(str, latest.latest_row(hot).collect()))


def test_edges(spark):
    name = make(spark, even(spark).limit(0))
    assert managed.read_table(spark, name).count() == 0
    nameless = spark.createDataFrame([(None, 2000), ("a", 2001)], "stn_code string, year int")
    assert managed.read_table(spark, make(spark, nameless)).count() == 2
    with pytest.raises(AnalysisException):
        managed.create_table(even(spark), name)
    managed.drop_table(spark, name)
    with pytest.raises(AnalysisException):
        spark.table(name)


def test_buckets_grow_in_number_with_the_rows(spark, monkeypatch):
    from rivulet.plans import q_sources

    monkeypatch.setattr(managed, "BUCKET_ROWS", 100)
    assert managed.buckets_for(even(spark).limit(0)) == 8 and managed.buckets_for(even(spark).limit(801)) == 9
    kept = q_sources.sample_table(spark, even(spark))
    shown = plan(latest.latest_row(kept))
    assert "SelectedBucketsCount: 40 out of 40" in shown and "hashpartitioning(stn_code" not in shown
    assert kept.count() == 4000 and len(kept.inputFiles()) <= 40
