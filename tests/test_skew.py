"""One station holds a third of all rows: results stay whole and the plans reduce before shuffles."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rivulet.operators import evaluate, forecast, latest, locate, score, stats
from rivulet.sources.tables import samples

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark):
    """Samples of which a third are moved to station 7, kept once for all tests."""
    rows = samples(spark, SF_DIR)
    moved = F.when(F.col("k1") % 3 == 0, "7").otherwise(F.col("stn_code"))
    return score.scored(rows.withColumn("stn_code", moved)).cache()


@pytest.fixture(scope="module")
def frame(hot):
    return hot.toPandas().sort_values(["year", "sampled_at", "k1", "k2", "k3"])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest(hot, frame):
    want = frame.groupby("stn_code")[["do_avg", "ph_avg", "pollution_score"]].last()
    got = latest.latest_per_station(hot, columns=["do_avg", "ph_avg", "pollution_score"])
    assert "partial_max" in plan(got) and "Window" not in plan(got)
    for r in got.collect():
        for c in ("do_avg", "ph_avg", "pollution_score"):
            value = want.loc[r["stn_code"], c]
            assert r[c] == value or (r[c] is None and value != value)


def test_latest_row(hot, frame):
    want = frame.groupby("stn_code").tail(1).set_index("stn_code")["k1"].to_dict()
    got = latest.latest_row(hot)
    assert "partial_max" in plan(got)
    assert {r["stn_code"]: r["k1"] for r in got.collect()} == want


def test_series_and_quantiles(hot, frame):
    want = frame.groupby(["stn_code", "year"])["pollution_score"].mean()
    got = forecast.yearly_series(hot).collect()
    assert len(got) == len(want)
    for r in got:
        assert r["y"] / 1e6 == pytest.approx(want[r["stn_code"], r["year"]], abs=1e-6)
    box = {r["water_body_type"]: r for r in evaluate.box_stats(hot).collect()}
    for kind, scores in frame.groupby("water_body_type")["pollution_score"]:
        assert (box[kind]["q1"], box[kind]["median"], box[kind]["q3"]) == pytest.approx(
            tuple(scores.quantile([0.25, 0.5, 0.75])))


def test_summaries(hot, frame):
    got = {r["year"]: r for r in stats.yearly_trend(hot).collect()}
    last = frame.groupby(["year", "stn_code"]).last().reset_index()
    for year, rows in last.groupby("year"):
        assert got[year]["avg_score"] == pytest.approx(rows["pollution_score"].mean(), abs=1e-4)
        assert got[year]["unsafe_count"] == (rows["safety_label"] == "Unsafe").sum()


def test_history_limits_before_the_shuffle(spark):
    turns = spark.createDataFrame([(c, t, "user", f"{c}-{t}") for c in range(4) for t in range(200 if c == 0 else 3)],
                                  "conv_id int, turn int, role string, text string")
    got = latest.chat_history_window(turns)
    assert "WindowGroupLimit" in plan(got)
    assert sorted(r["turn"] for r in got.filter("conv_id = 0").collect()) == [196, 197, 198, 199]


def test_lookups_keep_all_rows_of_a_hot_key(spark, hot):
    cache = hot.select("monitoring_location", "state").distinct().select(
        "*", F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng"), F.lit("q").alias("query"), F.lit(True).alias("success"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        located = locate.join_geocode_cache(hot, cache)
        assert "SortMergeJoin" in plan(located)
        assert located.filter("geocoded").count() == hot.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_picks_sort_gathered_rows(spark, hot):
    """A pick over gathered rows: balanced exchange of the rows first, the same rows as without it, none without a key."""
    rows = hot.unionByName(hot.limit(5).withColumn("stn_code", F.lit(None).cast("string"))).drop("violated_params")
    gathered = latest.gathered(rows, "stn_code")
    assert gathered.columns == rows.columns and gathered.count() == hot.count()
    got = latest.latest_row(gathered)
    shown = plan(got)
    assert "REBALANCE_PARTITIONS_BY_COL" in shown and "partial_max" in shown
    # Rows of a hot station may lie in several tasks, so the picks still meet by station.
    assert shown.count("Exchange hashpartitioning(stn_code") == 1
    assert sorted(map(str, got.collect())) == sorted(map(str, latest.latest_row(rows).collect()))


@pytest.mark.parametrize("name", ["latest_row", "latest_per_station", "retrieval_query_text", "merge_chat_answer",
                                  "suggest_questions", "station_context_line"])
def test_large_splits_are_not_sorted_whole(spark, name):
    from rivulet.plans import QUERIES

    assert "REBALANCE_PARTITIONS_BY_COL" in plan(QUERIES[name](spark, SF_DIR))
