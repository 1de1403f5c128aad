"""What sample files and their queries leave on disk."""

from __future__ import annotations

import datetime
import glob
import os
import time

import pytest

from rivulet.session import new_path, settings
from rivulet.sources import files, tables

COLUMNS = ["stn_code", "monitoring_location", "state", "year", "do_avg", "ph_avg", "bod_avg", "nitrate_avg",
           "fecal_coliform_avg", "pollution_score"]


def rows_of(spark, n=30_000):
    return spark.range(n).selectExpr(
        "cast(id as string) stn_code", "concat('Lake, \"', id, '\"\\nbank') monitoring_location",
        "if(id % 5 = 0, null, concat('State & ', id % 3)) state", "cast(2015 + id % 2 as int) year",
        "if(id % 7 = 0, null, id / 1000) do_avg", "7.5D ph_avg", "id % 40 / 7 bod_avg",
        "id / 3 nitrate_avg", "id % 900 / 11 fecal_coliform_avg", "50.5D pollution_score")


def shuffled(spark):
    """Shuffle files on disk and their bytes."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f: os.path.getsize(f) for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data") if os.path.exists(f)}


def left_behind(spark, before, most):
    """Bytes of the new ones, once they are no more than so many or after ten seconds."""
    end = time.time() + 10
    while (left := sum(n for f, n in shuffled(spark).items() if f not in before)) > most and time.time() < end:
        time.sleep(0.2)
    return left


@pytest.fixture
def folder(spark):
    path = new_path(spark, "stems")
    files.sink_state_year_csv(rows_of(spark), path)
    return path


def data_files(path):
    return [f for f in glob.glob(f"{path}/stem=*/*") if not f.endswith(".crc")]


def test_state_year_files_are_small_and_leave_no_shuffle_files(spark):
    before, path, plain = shuffled(spark), new_path(spark, "stems"), new_path(spark, "plain")
    files.sink_state_year_csv(rows_of(spark), path)
    assert left_behind(spark, before, 0) == 0
    files.sink_csv_flat(rows_of(spark), plain)
    size = sum(map(os.path.getsize, data_files(path)))
    assert size < 0.4 * sum(map(os.path.getsize, glob.glob(f"{plain}/part-*")))
    found = files.scan_samples_multi(spark, path, COLUMNS)
    wanted = rows_of(spark).where("state is not null")  # no stem without a state
    rows = [sorted(map(str, df.select(COLUMNS).collect())) for df in (found, wanted)]
    assert rows[0] == rows[1]


def test_a_compressed_file_holds_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(files, "FILE_ROWS", 500)
    path = new_path(spark, "stems")
    files.sink_state_year_csv(rows_of(spark, 6_000), path)
    counts = [r["n"] for r in files.scan_samples_multi(spark, path, COLUMNS).groupBy("path").count().withColumnRenamed("count", "n").collect()]
    assert sum(counts) == 4_800 and max(counts) <= 500


def test_rescored_files_are_not_shuffled(spark, folder):
    before, out = shuffled(spark), new_path(spark, "rescored")
    files.rescore_files(spark, folder, out, COLUMNS)
    assert left_behind(spark, before, 100_000) < 100_000  # splits only, not the rows
    again = files.scan_samples_multi(spark, out, COLUMNS)
    first = files.scan_samples_multi(spark, folder, COLUMNS)
    same = [c for c in COLUMNS if c != "pollution_score"]
    assert again.select(same).exceptAll(first.select(same)).count() == 0 and again.count() == first.count() == 24_000
    assert sum(map(os.path.getsize, data_files(out))) < 1.2 * sum(map(os.path.getsize, data_files(folder)))
    assert again.where("pollution_score = 50.5").count() == 0


def test_headers_are_sent_to_the_rows(spark, folder):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        found = files.scan_samples_csv(spark, folder, COLUMNS)
        assert "SortMergeJoin [split" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 30_000


@pytest.fixture(scope="module")
def star(spark):
    """Tables with keys that repeat or are missing on both sides."""
    path, day = new_path(spark, "star"), datetime.datetime
    lines = [(i, i % 9 or None, i % 6 or None, i % 7, float(i % 50), i * 1.25, 0.05, 0.02, day(1995 + i % 3, 1, 2) if i % 11 else None)
             for i in range(400)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (5, "d")], "p_partkey bigint, p_name string").write.parquet(
        f"{path}/part.parquet")
    spark.createDataFrame([(1, 1), (2, 2), (2, 2), (3, None), (None, 1), (4, 9)], "s_suppkey bigint, s_nationkey int").write.parquet(
        f"{path}/supplier.parquet")
    spark.createDataFrame([(1, "GOA"), (2, "DELHI"), (2, "BIHAR"), (None, "X"), (3, None)], "n_nationkey int, n_name string").write.parquet(
        f"{path}/nation.parquet")
    return path


def test_states_are_joined_without_a_shuffle_of_the_samples(spark, star):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "64k"}):
        plan = tables.samples(spark, star, names=False)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_dealt_samples_are_the_same_rows(spark, star):
    wanted = spark.sql(
        "select l_orderkey k1, n_name state, year(l_shipdate) year from parquet.`{0}/lineitem.parquet` left join (select * from "
        "parquet.`{0}/supplier.parquet` left join parquet.`{0}/nation.parquet` on s_nationkey = n_nationkey) on l_suppkey = s_suppkey".format(star))
    for dealt in (False, True):
        found = tables.samples(spark, star, names=False, dealt=dealt).select("k1", "state", "year")
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    one, two = (sorted(map(str, tables.samples(spark, star, dealt=d).collect())) for d in (False, True))
    assert one == two and len(one) > 400
