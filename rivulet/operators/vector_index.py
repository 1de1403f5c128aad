"""A kept index for exact nearest neighbours: pivots, distances to them, and the triangle inequality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.session import new_path

#: Vectors of one block of the index, and queries that one task holds against a block.
BLOCK, QUERY_GROUP = 2048, 512
#: Bounds are widened by this share, far above the rounding of distances, so that no neighbour is lost.
SLACK = 1e-9

_PLACED = "id bigint, v array<double>, pivot int, radius double"
_BLOCKS = "pivot int, low double, high double, size bigint, ids array<bigint>, radii array<double>, flat array<double>"


def _vectors(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """id and v of the rows that take part: known ids, vectors without nulls and not empty."""
    known = F.forall("v", lambda x: x.isNotNull()) & (F.size("v") > 0)
    return df.select(F.col(id_column).cast("bigint").alias("id"),
                     F.col(vector).cast("array<double>").alias("v")).dropna().filter(known)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to all pivots, a slice of rows at a time."""
    out = np.empty((len(vectors), len(pivots)))
    for at in range(0, len(vectors), 256):
        gap = vectors[at:at + 256, None, :] - pivots
        out[at:at + 256] = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
    return out


def build_index(chunks: DataFrame, chunk_id: str = "vec_id", vector: str = "embedding", pivots: int = 64,
                path: str | None = None, block: int = BLOCK) -> str:
    """Writes the index of all vectors and returns its folder.

    ``pivots`` vectors, those with the lowest hashes of their ids, are the fixed points; they are all
    that reaches the driver. Every vector goes to its nearest pivot, and the vectors of a
    pivot are kept in the order of their distance to it, in blocks of ``block`` vectors that
    know their least and largest distance. Rows are dealt by ranges of (pivot, distance, id), so a
    pivot with a third of all vectors takes many tasks and many blocks.
    """
    spark, path = chunks.sparkSession, path or new_path(chunks.sparkSession, "vector-index")
    held = _vectors(chunks, chunk_id, vector)
    lowest = held.orderBy(F.xxhash64("id"), "id", "v").limit(pivots).collect()
    points = np.array([r["v"] for r in lowest], dtype=float)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = _to_pivots(_matrix(batch.column("v")), points)
                nearest = away.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(nearest, pa.int32()), pa.array(away[np.arange(len(away)), nearest])],
                    ["id", "v", "pivot", "radius"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("pivot").to_numpy()
            cuts = np.flatnonzero(np.diff(numbers)) + 1
            for first, stop in zip([0, *cuts], [*cuts, len(numbers)]):
                for at in range(first, stop, block):
                    part = batch.slice(at, min(block, stop - at))
                    radii = part.column("radius")
                    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                             for x in (part.column("id"), radii, part.column("v").flatten())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([numbers[first]], pa.int32()), radii.slice(0, 1), radii.slice(len(radii) - 1),
                         pa.array([len(radii)], pa.int64()), *lists],
                        ["pivot", "low", "high", "size", "ids", "radii", "flat"])

    placed = spark.createDataFrame([], _PLACED) if not len(points) else held.mapInArrow(place, _PLACED)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (placed.repartitionByRange(parts, "pivot", "radius", "id").sortWithinPartitions("pivot", "radius", "id")
     .mapInArrow(pack, _BLOCKS).withColumn("block", F.monotonically_increasing_id()).write.parquet(f"{path}/blocks"))
    spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(points)],
                          "pivot int, v array<double>").write.parquet(f"{path}/pivots")
    return path


def _with_pivots(queries: DataFrame, points: np.ndarray) -> DataFrame:
    """id, v, pivot, away: a row for each query and pivot, with their distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = _to_pivots(_matrix(batch.column("v")), points)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(
                        pa.array(np.arange(len(away) + 1) * len(points), pa.int32()), pa.array(away.ravel()))], ["id", "v", "away"])

    found = queries.mapInArrow(run, "id bigint, v array<double>, away array<double>")
    return found.select("id", "v", F.posexplode("away").alias("pivot", "away"))


def _scan(k: int):
    """The k nearest members of a block for each of its queries, without those that a bound rules out."""
    names = ["query_id", "chunk_id", "distance"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].values for n in ("ids", "radii", "flat", "asked")}
                ids, radii = row["ids"].to_numpy(), row["radii"].to_numpy()
                members = row["flat"].to_numpy().reshape(len(ids), -1)
                for query in row["asked"].to_pylist():
                    reach = query["bound"] * (1 + SLACK) + SLACK
                    first = np.searchsorted(radii, query["away"] - reach, side="left")
                    stop = np.searchsorted(radii, query["away"] + reach, side="right")
                    gap = members[first:stop] - np.array(query["v"])
                    distance = np.einsum("ij,ij->i", gap, gap)
                    order = np.lexsort((ids[first:stop], distance))[:k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(order), query["id"])), pa.array(ids[first:stop][order]),
                         pa.array(distance[order])], names)

    return run


def _search(blocks: DataFrame, pairs: DataFrame, groups: int, k: int) -> DataFrame:
    """Candidates of (query, block) pairs: blocks meet their queries in groups of about QUERY_GROUP."""
    grouped = pairs.groupBy("block", F.pmod(F.xxhash64("id"), F.lit(groups)).alias("grp")).agg(
        F.collect_list(F.struct("id", "v", "away", "bound")).alias("asked"))
    return blocks.join(grouped, "block").select("ids", "radii", "flat", "asked").mapInArrow(
        _scan(k), "query_id bigint, chunk_id bigint, distance double")


def _least(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("distance", "chunk_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_index(spark, path: str, queries: DataFrame, k: int, query_id: str = "query_id",
                 vector: str = "embedding", count_pairs: bool = False) -> DataFrame:
    """query_id, chunk_id, distance (squared), rank of the k nearest vectors of every query, exact.

    Each query first reads the block that its own place among its nearest pivot's vectors falls in, and
    as many more of the nearest ones as hold k vectors; the k-th distance found bounds what it
    still needs. By the triangle inequality a block whose distances to its pivot all differ from the
    query's by more than that bound holds no nearer vector, and inside a block only such a range of rows
    is compared. Ties go to the lower id. Rows without id, and vectors that are null, empty or hold nulls,
    take no part; all vectors have one length. Of query rows with one id one counts. With ``count_pairs`` the
    result is one row instead: compared, possible (pairs of query and vector in the blocks read and in all).
    """
    types = "query_id bigint, chunk_id bigint, distance double, rank int"
    points = np.array([r["v"] for r in spark.read.parquet(f"{path}/pivots").orderBy("pivot").collect()], dtype=float)
    if k <= 0 or not len(points):
        return spark.createDataFrame([], types)
    blocks = spark.read.parquet(f"{path}/blocks")
    spans = blocks.select("pivot", "block", "low", "high", "size")
    asked = _vectors(queries, query_id, vector).groupBy("id").agg(F.min("v").alias("v"))
    groups = max(1, -(-asked.count() // QUERY_GROUP))
    away = _with_pivots(asked, points)
    every = away.join(spans, "pivot").withColumn("gap", F.greatest(
        F.lit(0.0), F.col("away") - F.col("high"), F.col("low") - F.col("away")))
    # Nearest blocks first, until they hold k vectors; only numbers of blocks are ranked, never vectors.
    closest = Window.partitionBy("id").orderBy("gap", "away", "block")
    first = every.select("id", "block", "gap", "away", "size").withColumn(
        "before", F.sum("size").over(closest) - F.col("size")).where(F.col("before") < k)
    near = first.select("id", "block", "away").join(asked, "id").withColumn("bound", F.lit(float("inf")))
    saved = new_path(spark, "nearest-first")
    _least(_search(blocks, near, groups, k), k).write.parquet(saved)
    some = spark.read.parquet(saved)
    bound = some.groupBy(F.col("query_id").alias("id")).agg(F.max("distance").alias("d"), F.count("*").alias("n")).select(
        "id", F.when(F.col("n") >= k, F.sqrt("d")).otherwise(F.lit(float("inf"))).alias("bound"))
    needed = every.join(bound, "id").where(F.col("gap") <= F.col("bound") * (1 + SLACK) + SLACK)
    later = needed.select("id", "v", "block", "away", "bound", "size").join(first.select("id", "block"), ["id", "block"], "left_anti")
    if count_pairs:
        read = later.select("id", "size").unionByName(first.select("id", "size")).agg(F.sum("size").alias("compared"))
        return read.withColumn("possible", F.lit(every.agg(F.sum("size")).first()[0]))
    rest = _search(blocks, later, groups, k)
    return _least(some.select("query_id", "chunk_id", "distance").unionByName(rest), k)
