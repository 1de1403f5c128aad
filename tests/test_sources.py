"""Scans, sinks and caches over hand-made files."""

from __future__ import annotations

import json
import os

import pytest

from rivulet import schema as S
from rivulet.session import new_path, shared_dir
from rivulet.sources import caches, files

FULL = "stn_code,monitoring_location,water_body_type,state,year,do_avg,ph_avg\n"
OTHER = "ph_avg,state,stn_code,monitoring_location,year,extra\n"


@pytest.fixture
def folder(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(tmp_path)
    return write


def test_csv_cells_are_placed_by_their_own_header(spark, folder):
    folder("goa_2018.csv", FULL + '11.0,"Kali\nbridge, ""old""",River,GOA,2018,6.5,NaN\n12,None,River,GOA,2018.0,x,7\n')
    root = folder("delhi_2019.csv", OTHER + "8.1,DELHI,13,Bay,2019,zz\n")
    got = {r["stn_code"]: r for r in files.scan_samples_csv(spark, root, S.EXTRACTED_COLUMNS).collect()}
    assert sorted(got) == ["11.0", "12", "13"]
    assert got["11.0"]["monitoring_location"] == 'Kali\nbridge, "old"'
    assert (got["11.0"]["do_avg"], got["11.0"]["ph_avg"]) == (6.5, None)
    assert (got["12"]["monitoring_location"], got["12"]["year"], got["12"]["do_avg"]) == (None, 2018, None)
    assert (got["13"]["ph_avg"], got["13"]["do_avg"], got["13"]["state"]) == (8.1, None, "DELHI")


def test_multi_scan_takes_year_and_state_from_the_name(spark, folder):
    for name in ("goa_2018.csv", "goa_2019.csv", "goa_2018_clean.csv", "west_bengal_2018.csv", "goa_train_2018.csv", "notes.csv"):
        root = folder(name, FULL + f"{name},x,River,GOA,2018,1,2\n")
    plain = files.scan_samples_multi(spark, root, S.EXTRACTED_COLUMNS, exclude_years=[2019])
    assert sorted((r["stn_code"], r["file_state"], r["file_year"]) for r in plain.collect()) == [
        ("goa_2018.csv", "Goa", 2018), ("west_bengal_2018.csv", "West Bengal", 2018)]
    clean = files.scan_samples_multi(spark, root, S.EXTRACTED_COLUMNS, cleaned=True)
    assert [r["stn_code"] for r in clean.collect()] == ["goa_2018_clean.csv"]


def test_year_folders(spark, folder):
    for name in ("2018/a.pdf", "2018/b.html", "2019/c.pdf", "other/d.pdf"):
        root = folder(name, "x")
    got = files.scan_year_partitions(spark, root, exclude_years=[2019]).collect()
    assert [(r["year"], os.path.basename(r["path"]), r["length"]) for r in got] == [(2018, "a.pdf", 1)]
    root = folder("2020/e.html", "xy")
    got = files.scan_year_partitions(spark, root, exclude_years=[2019]).collect()
    assert sorted((r["year"], os.path.basename(r["path"])) for r in got) == [(2018, "a.pdf"), (2020, "e.html")]
    assert files.scan_year_partitions(spark, root, fallback="").filter("year = 2020").count() == 0


def test_text_and_json_map(spark, folder, tmp_path):
    folder("t/a.txt", "line\n\nmore")
    assert [r["text"] for r in files.scan_text_whole(spark, str(tmp_path / "t")).collect()] == ["line\n\nmore"]
    cache = {"Kali|Goa": {"lat": 1.5, "lng": 2.0, "query": "kali", "success": True},
             "Nowhere|Goa": {"lat": None, "lng": None, "query": "n", "success": False}}
    folder("c/cache.json", json.dumps(cache, indent=2))
    rows = files.scan_json_map(spark, str(tmp_path / "c"), S.GEOCODE_CACHE, ["monitoring_location", "state"], r"\|").collect()
    assert sorted((r["monitoring_location"], r["state"], r["lat"], r["success"]) for r in rows) == [
        ("Kali", "Goa", 1.5, True), ("Nowhere", "Goa", None, False)]
    folder("i/insights.json", json.dumps({"BOD, pH__River": {"recommended_measures": ["a"], "retrieved_context_count": 2}}))
    row = files.scan_json_map(spark, str(tmp_path / "i"), S.INSIGHT_CACHE, ["violated_params", "kind"], "__").collect()[0]
    assert (row["kind"], row["recommended_measures"], row["retrieved_context_count"]) == ("River", ["a"], 2)


def test_csv_round_trip(spark):
    rows = [(1, ' a "b", c\nd '), (2, "plain"), (3, "x,y")]
    path = new_path(spark, "csv")
    files.sink_csv_flat(spark.createDataFrame(rows, "i int, t string"), path)
    assert sorted(tuple(r) for r in files.scan_csv_flat(spark, path, "i int, t string").collect()) == rows
    with pytest.raises(Exception):
        files.sink_csv_flat(spark.createDataFrame(rows, "i int, t string"), path)


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert sorted(tuple(r) for r in caches.cache_upsert(old, new, ["k"]).collect()) == [("a", 1), ("b", 3), ("c", 4)]
    assert [tuple(r) for r in caches.anti_uncached(new.union(new), old, ["k"]).collect()] == [("c",)]
    assert caches.cached_count(new.union(new), old, ["k"]).collect()[0][0] == 2
    chunks = spark.createDataFrame([("s1", 0), ("s1", 1), ("s2", 0)], "source string, i int")
    again = spark.createDataFrame([("s1", 0)], "source string, i int")
    assert sorted(tuple(r) for r in caches.source_replace_upsert(chunks, again).collect()) == [("s1", 0), ("s2", 0)]
    seen = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, t int, v string")
    assert sorted(tuple(r) for r in caches.newest_per_key(seen, ["k"], ["t"]).select("k", "v").collect()) == [("a", "y"), ("b", None)]


class Session:
    """Stands for a cluster's session: only its settings are read."""

    def __init__(self, settings, master="spark://cluster"):
        self.settings, self.conf, self.sparkContext, self.master = settings, self, self, master

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def getConf(self):
        return self


def test_shared_folder_is_the_cluster_checkpoint_folder(spark):
    assert shared_dir(Session({"spark.checkpoint.dir": "hdfs:///work/"})) == "hdfs:///work"
    with pytest.raises(ValueError):
        shared_dir(Session({}))
    assert shared_dir(spark) == shared_dir(spark)


def test_headers_of_any_width_and_case(spark, tmp_path):
    from rivulet import schema

    wide = [f"extra_{i}" for i in range(30)]
    (tmp_path / "wide_2018.csv").write_text(
        ",".join([*wide, " Stn_Code ", "Monitoring_Location", "DO_avg"]) + "\n"
        + ",".join([*["0"] * 30, "7", "Lake", "6.5"]) + "\n")
    (tmp_path / "plain_2018.csv").write_text("monitoring_location,do_avg\nRiver,1e308\nPond,9e999\n")
    found = files.scan_samples_csv(spark, str(tmp_path), schema.EXTRACTED_COLUMNS).collect()
    assert sorted((r.stn_code or "", r.monitoring_location, r.do_avg) for r in found) == [
        ("", "Pond", None), ("", "River", 1e308), ("7", "Lake", 6.5)]
    (tmp_path / "none_2018.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="none_2018.csv"):
        files.scan_samples_csv(spark, str(tmp_path), schema.EXTRACTED_COLUMNS).collect()
