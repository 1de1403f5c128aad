"""Quoted CSV read in many splits, against the csv module."""

from __future__ import annotations

import csv
import io
import random

import pytest

from rivulet import schema as S
from rivulet.sources import files, quoted

HEADER = "stn_code,monitoring_location,water_body_type,state,year,do_avg,ph_avg"


def awkward_rows(seed: int, n: int) -> list[list[str]]:
    rng = random.Random(seed)
    pieces = ["bank", "\n", "\r\n", '"', ",", "\n\n", " é ", "x" * 40, "\t"]
    rows = []
    for i in range(n):
        place = "p" + "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 9))) + "q"
        rows.append([str(i), place, "River", "GOA", "2018", "6.5", "7.1"])
    return rows


def write(path, rows, header=HEADER, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(header.split(","))
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield to
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


@pytest.mark.parametrize("size", [150, 3_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_split_size_gives_the_same_rows(spark, tmp_path, small_splits, size, end):
    small_splits(size)
    rows = awkward_rows(size, 70)
    write(tmp_path / "goa_2018.csv", rows, end=end)
    write(tmp_path / "goa_2019.csv", rows[:3], end=end)
    records, splits = quoted.scan_records(spark, str(tmp_path))
    assert splits.count() > (20 if size < 1_000 else 1)
    found = files.scan_samples_csv(spark, str(tmp_path), S.EXTRACTED_COLUMNS).collect()
    assert sorted((r["stn_code"], r["monitoring_location"]) for r in found) == sorted((r[0], r[1]) for r in rows + rows[:3])
    assert {r["ph_avg"] for r in found} == {7.1}


@pytest.mark.parametrize("few", [True, False])
def test_long_cells_and_sorted_lines(spark, tmp_path, small_splits, monkeypatch, few):
    """A cell over many splits, kept lines above the limit, and more splits than may be broadcast."""
    monkeypatch.setattr(quoted, "BROADCAST_SPLITS", 50_000 if few else 2)
    small_splits(500)
    rows = [["1", "a\n" * 2_000 + "end", "River", "GOA", "2018", "1", "2"], *awkward_rows(5, 40)]
    write(tmp_path / "goa_2018.csv", rows)
    expected = sorted((r[0], r[1]) for r in rows)
    for kept in (1 << 20, 100):
        monkeypatch.setattr(quoted, "KEPT", kept)
        found = files.scan_samples_csv(spark, str(tmp_path), S.EXTRACTED_COLUMNS).collect()
        assert sorted((r["stn_code"], r["monitoring_location"]) for r in found) == expected


def test_only_the_first_row_is_a_header(spark, tmp_path):
    rows = [["1", "stn_code", "River", "GOA", "2018", "1", "2"], ["stn_code", "x", "y", "z", "2018", "", ""]]
    write(tmp_path / "goa_2018.csv", rows)
    found = files.scan_samples_csv(spark, str(tmp_path), S.EXTRACTED_COLUMNS)
    assert sorted(r["stn_code"] for r in found.collect()) == ["1", "stn_code"]
    (tmp_path / "goa_2019.csv").write_text('"a\nb",stn_code\n1,2\n')
    with pytest.raises(Exception, match="line break in the header"):
        files.scan_samples_csv(spark, str(tmp_path), S.EXTRACTED_COLUMNS).collect()


def test_empty_and_blank_files(spark, tmp_path):
    (tmp_path / "goa_2018.csv").write_text("")
    (tmp_path / "goa_2019.csv").write_text("\n\n" + HEADER + "\n\n1,a,River,GOA,2018,1,2\n  \n")
    found = files.scan_samples_csv(spark, str(tmp_path), S.EXTRACTED_COLUMNS).collect()
    assert [(r["stn_code"], r["do_avg"]) for r in found] == [("1", 1.0)]


def test_numbers_of_a_row_are_parsed_in_one_place(spark, tmp_path):
    """A parser for each column grows into a method that the JVM does not compile."""
    rows = [["1", "a", "River", "GOA", " 2018 ", "\t6.5 ", "7d"], ["2", " N/A ", "NA", " nan", "x", "1e3", ".5"]]
    write(tmp_path / "goa_2018.csv", rows)
    found = files.scan_samples_csv(spark, str(tmp_path), S.EXTRACTED_COLUMNS)
    got = {r["stn_code"]: r for r in found.collect()}
    assert [got["1"][c] for c in ("monitoring_location", "state", "year", "do_avg", "ph_avg")] == ["a", "GOA", 2018, 6.5, None]
    assert [got["2"][c] for c in ("monitoring_location", "water_body_type", "state", "year", "do_avg", "ph_avg")] == [
        None, None, None, None, 1000.0, 0.5]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("[eE]") <= 6


def test_records_of_many_lines_over_two_batches():
    import pyarrow as pa

    n = 30_000
    lines = ["h", *(x for i in range(n) for x in (f'{i},"a', "b", 'c"'))]
    taken = pa.RecordBatch.from_pydict({
        "split": [5] * len(lines), "block": [0] * len(lines), "inside": [False] * len(lines), "value": lines})
    parts = [taken.slice(0, 50_000), taken.slice(50_000)]
    found = [r for b in quoted._cut(fragments=False)(iter(parts)) for r in zip(b["row"].to_pylist(), b["record"].to_pylist())]
    assert found == [(3 * i, f'{i},"a\nb\nc"') for i in range(n)]
