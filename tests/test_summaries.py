"""Summary states: a refresh reads changed years only and equals a full run."""

from __future__ import annotations

import os
import random
import re
import tempfile

import pytest

from rivulet.operators import stats, summaries

ROWS = "stn_code string, year int, k1 int, pollution_score double, safety_label string"


def samples(spark, years, seed, stations=12):
    draw = random.Random(seed)
    rows = [(draw.choice([None, *map(str, range(stations))]), y, draw.randrange(99), draw.choice([None, round(draw.random(), 3)]),
             draw.choice([None, "Safe", "Unsafe"])) for y in years for _ in range(40)]
    return spark.createDataFrame(rows, ROWS)


def write(df, folder, mode="append"):
    df.coalesce(1).write.mode(mode).partitionBy("year").parquet(folder)


@pytest.fixture
def places(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    folder, path = f"{root}/rows", f"{root}/states"
    write(samples(spark, [2001, 2002, 2003, None], 1), folder)
    summaries.create_summaries(spark, path, folder, buckets=4)
    return folder, path


def same_as_full(spark, folder, path):
    rows, states = spark.read.parquet(folder), summaries.read_states(spark, path)
    assert summaries.overview_from(states).collect() == stats.overview_stats(rows).collect()
    assert summaries.overview_from(states, 2002).collect() == stats.overview_stats(rows, 2002).collect()
    assert sorted(summaries.trend_from(states).collect()) == sorted(stats.yearly_trend(rows).collect())


def listing(path):
    return sorted(os.path.join(folder, name) for folder, _, names in os.walk(path) for name in names)


def test_only_changed_years_are_read(spark, places):
    folder, path = places
    assert summaries.refresh(spark, path, folder) == [2001, 2002, 2003]
    same_as_full(spark, folder, path)
    before = listing(path)
    assert summaries.refresh(spark, path, folder) == [] and listing(path) == before
    write(samples(spark, [2002], 2), folder)
    assert [r.year for r in summaries.changed_years(spark, path, folder).collect()] == [2002]
    one = summaries.year_states(summaries.rows_of_years(spark, folder, [2002]))
    one.collect()
    scan = re.search(r"PartitionFilters: \[(.*?)\], ", one._jdf.queryExecution().executedPlan().toString())[1]
    assert "year" in scan and "2002" in scan and "2003" not in scan
    assert summaries.refresh(spark, path, folder) == [2002]
    same_as_full(spark, folder, path)


def test_a_year_that_left_and_an_interruption(spark, places):
    folder, path = places
    summaries.refresh(spark, path, folder)
    other = folder + "-other"
    write(samples(spark, [2003, 2004], 3), other)
    # Another folder: 2003 has other files, 2004 is new, the rest is gone. The state was written, the listing not.
    from rivulet.sources import store

    gone = spark.createDataFrame([(y,) for y in (2001, 2002, 2003, 2004)], "year int")
    lost = store.prepare_upsert(spark, f"{path}/states", summaries.year_states(spark.read.parquet(other)), gone)
    same_as_full(spark, folder, path)
    store.commit_upsert(spark, f"{path}/states", lost)
    assert summaries.refresh(spark, path, other) == [2001, 2002, 2003, 2004]
    same_as_full(spark, other, path)
    assert {r.year for r in summaries.read_states(spark, path).collect()} == {2003, 2004}
