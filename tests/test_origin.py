"""The place of a row in its files orders rows as they were written, however the files are split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rivulet.operators import latest
from rivulet.sources import files
from test_quoted import awkward_rows, small_splits, write  # noqa: F401

COLUMNS = ["stn_code", "monitoring_location", "year", "do_avg"]


@pytest.mark.parametrize("size", [170, 100_000])
def test_csv_rows_keep_the_order_of_the_file(spark, tmp_path, small_splits, size):  # noqa: F811
    small_splits(size)
    rows = awkward_rows(3, 40)
    write(tmp_path / "goa_2019.csv", rows[:25])
    write(tmp_path / "goa_2018.csv", rows[25:])
    found = files.scan_samples_csv(spark, str(tmp_path), COLUMNS, origin=True)
    in_order = [r.stn_code for r in found.repartition(3).orderBy("origin").collect()]
    assert in_order == [r[0] for r in rows[25:] + rows[:25]]
    places = found.select("origin").collect()
    assert len(set(places)) == len(rows) and (len({(p[0].path, p[0].block) for p in places}) > 10) == (size < 1_000)


def test_first_and_last_by_place(spark, tmp_path):
    def rows(*cells):
        return [[code, place, "River", "GOA", "2018", value, ""] for code, place, value in cells]

    write(tmp_path / "goa_2018.csv", rows(("9", "Dam", "5"), ("1", "dam", "7"), ("1", "Pier", "")))
    write(tmp_path / "goa_2017.csv", rows(("4", "DAM ", "8"), ("1", "nan", "6")))
    found = files.scan_samples_csv(spark, str(tmp_path), COLUMNS, origin=True)
    seen = latest.manifest_first_seen(found.withColumn("state", F.lit("Goa")), "state", ["origin"]).collect()
    assert {(r.monitoring_location, r.stn_code) for r in seen} == {("DAM", "4"), ("Pier", "1")}
    # The last known value of station 1 is in the file that sorts last, before a row without one.
    last = latest.last_per_station_year(found, order=["origin"], columns=["do_avg"]).collect()
    assert {r.stn_code: r.do_avg for r in last} == {"9": 5.0, "1": 7.0, "4": 8.0}
    unique = latest.dedupe_locations(found.select("stn_code", "monitoring_location", "origin"), "stn_code", ["origin"])
    assert {r.stn_code: r.monitoring_location for r in unique.collect()}["1"] == "Pier"


def test_parquet_rows_of_several_files(spark, tmp_path):
    for name, start in (("b", 0), ("a", 500)):
        spark.range(start, start + 400, 1, 1).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    found = files.scan_parquet_origin(spark, [f"{tmp_path}/b", f"{tmp_path}/a"]).filter("id % 2 = 0")
    assert [r.id for r in found.repartition(4).orderBy("origin").collect()] == [*range(500, 900, 2), *range(0, 400, 2)]
    assert found.select("origin.row").agg(F.max("row")).first()[0] == 398
