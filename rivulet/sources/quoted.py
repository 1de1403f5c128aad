"""Records of CSV files whose quoted cells may hold line breaks, read in parallel splits.

A line of such a file is a record of its own only outside quotes, and a split cannot see by itself
whether it starts inside a cell. Two scans settle it: the first counts the quotes of every split, and the
prefix sum of their parity over the splits of a file tells where each one starts; the second cuts
every split into records. A record that crosses splits is put together from the few lines at their
ends, which the first scan has kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rivulet.session import new_path

#: Longest text that the first scan keeps for each end of a split; longer cells cost a third scan.
KEPT = 1 << 20
#: Splits (about a hundred bytes each) whose table is broadcast; beyond that lines are sorted by split.
BROADCAST_SPLITS = 50_000
#: Place of a record behind all others that begin in its split.
AFTER_ALL = 1 << 62

_SURVEY = ("path string, block bigint, first string, odd boolean, closes boolean, tail string, "
           "tail_long boolean, head string, head_long boolean")


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(paths).select(
        meta["file_path"].alias("path"), meta["file_block_start"].cast("bigint").alias("block"), "value")


def _odd(lines: pa.Array) -> np.ndarray:
    """Which lines hold an odd number of quotes."""
    return (pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) & 1).astype(bool)


class _Kept:
    """Lines kept up to a size; beyond it only the fact that there were more."""

    def __init__(self) -> None:
        self.parts, self.size, self.long = [], 0, False

    def add(self, lines: pa.Array) -> None:
        self.size += (pc.sum(pc.binary_length(lines)).as_py() or 0) + len(lines)
        self.long = self.long or self.size > KEPT
        self.parts = [] if self.long else [*self.parts, lines]

    def text(self) -> str | None:
        return None if self.long else "\n".join(x for part in self.parts for x in part.to_pylist())


class _Split:
    """What the first scan remembers of one split."""

    def __init__(self, path: str, block: int) -> None:
        self.path, self.block, self.first = path, block, None
        self.parity, self.closes, self.tail, self.head = 0, False, _Kept(), None

    def add(self, lines: pa.Array) -> None:
        if self.first is None and self.block == 0:
            self.first = next((x for x in lines.to_pylist() if x.strip("\r﻿ \t")), None)
        at = np.flatnonzero(_odd(lines))
        if not self.closes:
            self.tail.add(lines.slice(0, int(at[0]) + 1) if len(at) else lines)
        if len(at):
            self.closes, self.head = True, _Kept()
            self.head.add(lines.slice(int(at[-1])))
        elif self.head:
            self.head.add(lines)
        self.parity ^= len(at) & 1

    def row(self) -> tuple:
        head = self.head or _Kept()
        return (self.path, self.block, self.first, bool(self.parity), self.closes, self.tail.text(), self.tail.long,
                head.text(), head.long)


def _runs(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Stretches of rows with equal keys."""
    n = batch.num_rows
    change = np.zeros(max(n - 1, 0), dtype=bool)
    for key in keys:
        column = batch.column(key)
        change |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


def _survey(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}[k])
                        for n, k in (x.strip().split(" ") for x in _SURVEY.split(","))])

    def emit(split: _Split) -> pa.RecordBatch:
        return pa.record_batch([pa.array([v], type=f.type) for v, f in zip(split.row(), schema)], schema=schema)

    split: _Split | None = None
    for batch in source:
        for a, b in _runs(batch, ("path", "block")):
            key = batch.column("path")[a].as_py(), batch.column("block")[a].as_py()
            if split is None or (split.path, split.block) != key:
                if split is not None:
                    yield emit(split)
                split = _Split(*key)
            split.add(batch.column("value").slice(a, b - a))
    if split is not None:
        yield emit(split)


def _joined(lines: pa.Array, starts: np.ndarray | list[int]) -> pa.Array:
    """Lines from each start to the next one (or the end) as one text."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([*starts, len(lines)], type=pa.int32()), lines), "\n")


def _cut(fragments: bool):
    """Records that lie in one split, or with ``fragments`` the lines at its ends that do not.

    ``row`` counts lines from the start of the split, so it orders the records of a split."""
    schema = pa.schema([("split", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("row", pa.int64()),
                        ("record", pa.string())])

    def out(split: tuple[int, int], texts: pa.Array, rows: np.ndarray | list[int], kind: int = 0) -> pa.RecordBatch:
        n = len(texts)
        return pa.record_batch([pa.array(np.full(n, split[0])), pa.array(np.full(n, split[1])),
                                pa.array(np.full(n, kind, dtype=np.int32)), pa.array(rows, type=pa.int64()), texts],
                               schema=schema)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, inside, foreign, header, held, begun, seen = None, 0, False, False, [], 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            if fragments and held:
                yield out(last, _joined(pa.concat_arrays(held), [0]), [begun], 0 if foreign else 1)

        for batch in source:
            for a, b in _runs(batch, ("split",)):
                split = batch.column("split")[a].as_py(), batch.column("block")[a].as_py()
                if split != last:
                    yield from close()
                    inside = int(batch.column("inside")[a].as_py())
                    last, foreign, held, seen = split, bool(inside), [], 0
                    header = split[1] == 0
                lines = batch.column("value").slice(a, b - a)
                if header:
                    at = next((i for i, x in enumerate(lines.to_pylist()) if x.strip("\r﻿ \t")), len(lines))
                    header, lines = at == len(lines), lines.slice(at + 1)
                if not len(lines):
                    continue
                after = (inside + np.cumsum(_odd(lines))) & 1
                ends = np.flatnonzero(after == 0) + 1  # one past the last line of each record that ends here
                done = int(ends[-1]) if len(ends) else 0
                if inside and done:
                    # The last lines of a cell that began in an earlier split belong to that split's record.
                    if foreign == fragments:
                        first = pa.concat_arrays([*held, lines.slice(0, int(ends[0]))])
                        yield out(split, _joined(first, [0]), [begun])
                    foreign, held = False, []
                starts = ends[:-1] if inside else np.concatenate([[0], ends[:-1]])[:len(ends)]
                if not fragments and len(starts):
                    one = len(starts) == done - starts[0]  # no record here has a line break
                    yield out(split, lines.slice(int(starts[0]), done - int(starts[0])) if one
                              else _joined(lines.slice(0, done), starts), seen + starts)
                if done < len(lines):
                    if not held:
                        begun = seen + done
                    held = [*held, lines.slice(done)]
                inside = int(after[-1])
                seen += len(lines)
        yield from close()

    return run


def scan_records(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(split, block, row, record) of every record but each file's first, and (split, path, header) of every split.

    A record is the text of a row, line breaks in its cells kept. The first line of a file that is not
    blank is its header; it must not hold a line break. Blank records are left out. Rows come
    in any order; block and row, in this sequence, are the place of a record in its file. Files that cannot be split (compressed ones) are one split each.
    """
    found = new_path(spark, "csv-splits")
    _lines(spark, paths).mapInArrow(_survey, _SURVEY).withColumn(
        "split", F.monotonically_increasing_id()).write.parquet(found)
    file = W.partitionBy("path").orderBy("block")
    splits = spark.read.parquet(found).withColumn("inside", F.coalesce(
        F.sum(F.col("odd").cast("int")).over(file.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) % 2 == 1)
    splits = splits.withColumns({
        "ends": F.col("inside") != F.col("odd"),
        "header": F.regexp_replace(F.max("first").over(W.partitionBy("path")), r"^﻿|\r$", "")})
    broken = F.length("header") - F.length(F.replace("header", F.lit('"')))
    splits = splits.withColumn("header", F.when(broken % 2 == 0, F.col("header")).otherwise(F.when(
        F.col("header").isNotNull(), F.raise_error(F.concat(F.lit("line break in the header of "), F.col("path"))))))
    known = splits.select("path", "block", "split", "inside")
    few = splits.count() <= BROADCAST_SPLITS

    def lines() -> DataFrame:
        placed = _lines(spark, paths)
        placed = placed if few else placed.withColumn("at", F.monotonically_increasing_id())
        joined = placed.join(F.broadcast(known) if few else known, ["path", "block"], "left").withColumn(
            "split", F.coalesce("split", F.raise_error(F.lit("splits changed between scans")).cast("bigint")))
        if not few:  # a shuffle loses the order of lines
            joined = joined.repartition("split").sortWithinPartitions("split", "at")
        return joined.select("split", "block", "inside", "value")

    kinds = "split bigint, block bigint, kind int, row bigint, record string"
    whole = lines().mapInArrow(_cut(fragments=False), kinds).select("split", "block", "row", "record")
    tail = splits.where("inside").select("path", "block", "split", F.lit(0).alias("kind"), F.col("tail").alias("record"))
    head = splits.where("ends and closes").select(
        "path", "block", "split", F.lit(1).alias("kind"), F.col("head").alias("record"))
    if splits.where("(inside and tail_long) or (ends and closes and head_long)").limit(1).count():
        ends = lines().mapInArrow(_cut(fragments=True), kinds).drop("row").join(splits.select("path", "split"), "split")
    else:
        ends = tail.unionByName(head)
    order = W.partitionBy("path").orderBy("block", "kind")
    crossing = ends.withColumn("begun", F.sum("kind").over(order)).groupBy("path", "begun").agg(
        F.min("split").alias("split"), F.sort_array(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"))
    # A record that leaves its split is the last that begins there.
    crossing = crossing.select("split", F.get("parts", F.lit(0))["block"].alias("block"), F.lit(AFTER_ALL).alias("row"), F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    records = whole.unionByName(crossing).withColumn("record", F.when(
        F.endswith("record", F.lit("\r")), F.left("record", F.length("record") - 1)).otherwise(F.col("record")))
    return records.where(F.trim("record") != ""), splits.select("split", "path", "header")
