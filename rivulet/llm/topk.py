"""Exact top-k search by inner product over a bit-sliced index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import arrow_schema

#: Quantised components are held within this size.
LARGEST = 1 << 55
#: The lower part of a score whose upper part is kept apart: 63 bits.
LOWER = (1 << 63) - 1
#: Queries whose sums are formed together.
TOGETHER = 8


def bit_sliced_topk(index: DataFrame, queries: DataFrame, k: int = 20, id_column: str = "vec_id",
                    vector_column: str = "embedding", scale: int = 64, block_rows: int = 8192,
                    group_rows: int = 512) -> DataFrame:
    """The ``k`` rows of ``index`` with the highest integer inner product for each query row.

    Components become floor(scale * x), x as double. The index is cut into blocks of at most
    ``block_rows`` rows, and each block holds one bitmap per dimension and bit: the slices. A
    query adds the slices of its dimensions, shifted by the set bits of its own components, with
    bitwise adders, so that the sums of all rows of the block arise at once, again as slices. Rows
    are chosen from the highest slice downward until at most k remain undecided, and the rows tied
    at the boundary are taken by smallest id. Blocks meet groups of ``group_rows`` queries, so a
    task holds one block and one group, whatever the sizes of the tables.

    Returns query_id, rank (from 1), vec_id, score. Scores are exact; ties go to the smaller id; a
    query with fewer than k other rows gets all of them. Vectors that are null or hold null or
    non-finite components take no part, nor do rows without id. Shorter vectors count as padded with
    zeros. A row is never a result of a query with the same id; other repeated rows are candidates
    each. Of several query rows with one id the smallest vector is taken. Other columns are ignored.
    Rows are chosen by exact scores of any size; a score that leaves 64 bits is returned as null.
    Quantised components beyond 2^55 in size count as 2^55. Empty tables give no rows.
    """
    held = _quantised(index, id_column, vector_column, scale)
    asked = (_quantised(queries, id_column, vector_column, scale)
             .groupBy("id").agg(F.min("v").alias("v")))
    n_rows, n_asked = held.count(), asked.count()
    n_blocks, n_groups = max(1, -(-n_rows // block_rows)), max(1, -(-n_asked // group_rows))

    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")
    schema = "block int, rows int, bits int, dims int, ids binary, low binary, slices binary"
    blocks = (
        held.withColumn("block", block).repartition(n_blocks, "block")
        .sortWithinPartitions("block", "id")
        .mapInArrow(_slicer(block_rows), schema)
        .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))))
    groups = (
        asked.select(F.pmod(F.xxhash64("id"), F.lit(n_groups)).cast("int").alias("grp"),
                     F.struct("id", "v").alias("q"))
        .groupBy("grp").agg(F.sort_array(F.collect_list("q")).alias("qs"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))
    found = (blocks.join(groups, ["block", "grp"])
             .select("rows", "bits", "dims", "ids", "low", "slices", "qs")
             .mapInArrow(_searcher(k), "query_id bigint, vec_id bigint, upper bigint, lower bigint"))
    order = "row_number() over (partition by query_id order by upper desc, lower desc, vec_id)"
    score = F.when(F.col("upper").isin(0, -1), F.shiftleft("upper", 63).bitwiseOR(F.col("lower")))
    return (found.withColumn("rank", F.expr(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", score.alias("score")))


def _quantised(df: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    vector = F.col(vector_column).cast(T.ArrayType(T.DoubleType()))
    finite = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    # Bounded as doubles: the product may be infinite, which no whole number holds.
    whole = F.transform(vector, lambda x: F.floor(
        F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))))
    return (df.select(F.col(id_column).cast("bigint").alias("id"), vector.alias("x"))
            .select("id", F.col("x").alias(vector_column))
            .where(F.col("id").isNotNull() & F.col(vector_column).isNotNull() & finite)
            .select("id", whole.alias("v")))


def _matrix(vectors: pa.Array) -> np.ndarray:
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _slicer(block_rows: int):
    """Cuts the ordered rows of a task into blocks and each block into slices."""
    schema = arrow_schema("block int, rows int, bits int, dims int, ids binary, "
                                "low binary, slices binary")

    def emit(number: int, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        low = v.min(axis=0) if v.size else np.zeros(v.shape[1], dtype=np.int64)
        u = v - low
        bits = max(1, int(u.max(initial=0)).bit_length())
        words = -(-len(ids) // 64)
        padded = np.zeros((v.shape[1], bits, words * 64), dtype=np.uint8)
        for b in range(bits):
            padded[:, b, :len(ids)] = ((u >> b) & 1).T
        slices = np.packbits(padded, axis=2, bitorder="little")
        return pa.record_batch([[number], [len(ids)], [bits], [v.shape[1]], [ids.tobytes()],
                                [low.tobytes()], [slices.tobytes()]], schema=schema)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_block, ids, vectors, count = None, [], [], 0

        def close() -> pa.RecordBatch:
            dims = max(x.shape[1] for x in vectors)
            wide = [np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in vectors]
            return emit(open_block, np.concatenate(ids), np.concatenate(wide))

        for batch in source:
            if not batch.num_rows:
                continue
            numbers = batch.column("block").to_numpy()
            own_ids, own = batch.column("id").to_numpy(), _matrix(batch.column("v"))
            at = 0
            while at < len(numbers):
                if count and (numbers[at] != open_block or count >= block_rows):
                    yield close()
                    ids, vectors, count = [], [], 0
                open_block = int(numbers[at])
                same = np.searchsorted(numbers[at:], open_block, side="right")
                stop = at + min(int(same), block_rows - count)
                ids.append(own_ids[at:stop])
                vectors.append(own[at:stop])
                count += stop - at
                at = stop
        if count:
            yield close()

    return run


def weighted_sums(pool: np.ndarray, bits: int, weights: np.ndarray) -> list[np.ndarray]:
    """Slices of the sums over dimensions of |weight| times the value or its complement.

    ``pool`` has the slices of every dimension, then their complements, then an empty bitmap, as
    rows of words; ``weights`` is (queries, dimensions). Result: for each power of two a
    (queries, words) bitmap, lowest first.
    """
    n_queries, dims = weights.shape
    size, empty = np.abs(weights), pool.shape[0] - 1
    base = (np.arange(dims) + np.where(weights < 0, dims, 0)) * bits
    columns: dict[int, list[np.ndarray]] = {}
    for j in range(int(size.max(initial=0)).bit_length()):
        chosen = ((size >> j) & 1).astype(bool)
        for b in range(bits):
            columns.setdefault(j + b, []).append(np.where(chosen, base + b, empty))
    gathered: dict[int, np.ndarray] = {}
    for power, parts in columns.items():
        rows = np.sort(np.concatenate(parts, axis=1), axis=1)
        used = int((rows != empty).sum(axis=1).max(initial=0))
        gathered[power] = rows[:, :used]
    sums, power, carried = [], 0, []
    while power <= max(gathered, default=-1) or carried:
        rows = gathered.get(power)
        parts = carried + ([pool[rows]] if rows is not None and rows.shape[1] else [])
        carried = []
        if not parts:
            sums.append(np.zeros((n_queries, pool.shape[1]), dtype=np.uint64))
            power += 1
            continue
        left = parts[0] if len(parts) == 1 else np.concatenate(parts, axis=1)
        while left.shape[1] > 1:
            n = left.shape[1] // 3
            if n:
                x, y, z = left[:, :n], left[:, n:2 * n], left[:, 2 * n:3 * n]
                odd = x ^ y
                carried.append((x & y) | (z & odd))
                odd ^= z
                left = np.concatenate([odd, left[:, 3 * n:]], axis=1)
            else:
                x, y = left[:, :1], left[:, 1:2]
                carried.append(x & y)
                left = x ^ y
        sums.append(left[:, 0])
        power += 1
    return sums


def select_top(sums: list[np.ndarray], allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the rows surely among the k highest, and of those tied at the boundary."""
    sure, open_rows = np.zeros_like(allowed), allowed.copy()
    for bits in reversed(sums):
        tops = open_rows & bits
        several = np.bitwise_count(sure | tops).sum(axis=1) > k
        sure = np.where(several[:, None], sure, sure | tops)
        open_rows = np.where(several[:, None], tops, open_rows & ~bits)
    return sure, open_rows


def _searcher(k: int):
    schema = arrow_schema("query_id bigint, vec_id bigint, upper bigint, lower bigint")

    def block_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (row["dims"] * row["bits"], -(-row["rows"] // 64))
        slices = np.frombuffer(row["slices"], dtype=np.uint64).reshape(shape)
        pool = np.concatenate([slices, ~slices, np.zeros((1, shape[1]), dtype=np.uint64)])
        return np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(
            row["low"], dtype=np.int64), pool

    def search(row: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        ids, low, pool = block_of(row)
        dims, bits = row["dims"], row["bits"]
        words = pool.shape[1]
        exists = np.zeros(words * 64, dtype=np.uint8)
        exists[:len(ids)] = 1
        queries = row["qs"]
        for at in range(0, len(queries), TOGETHER):
            part = queries[at:at + TOGETHER]
            weights = np.zeros((len(part), dims), dtype=np.int64)
            for i, q in enumerate(part):
                own = q["v"][:dims]
                weights[i, :len(own)] = own
            sums = weighted_sums(pool, bits, weights)
            # The complement of u stands for 2^bits - 1 - u, which this offset takes back.
            # Whole numbers of any size, one for each query.
            offset = weights.astype(object) @ low.astype(object) + np.minimum(weights, 0).astype(
                object).sum(axis=1) * ((1 << bits) - 1)
            allowed = np.repeat(exists[None], len(part), axis=0)
            for i, q in enumerate(part):
                first, last = np.searchsorted(ids, [q["id"], q["id"] + 1])
                allowed[i, first:last] = 0
            packed = np.packbits(allowed, axis=1, bitorder="little").view(np.uint64)
            sure, tied = select_top(sums, packed, k)
            for i, q in enumerate(part):
                rows = np.flatnonzero(np.unpackbits(sure[i].view(np.uint8), bitorder="little"))
                more = np.flatnonzero(np.unpackbits(tied[i].view(np.uint8), bitorder="little"))
                rows = np.concatenate([rows, more[:k - len(rows)]])
                small = len(sums) <= 62 and abs(offset[i]) < 1 << 62
                score = np.full(len(rows), offset[i], dtype=np.int64 if small else object)
                for power, bitmap in enumerate(sums):
                    on = (bitmap[i, rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
                    score += on.astype(score.dtype) << power
                yield q["id"], ids[rows], score

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i in range(batch.num_rows):
                held = list(search(batch.slice(i, 1).to_pylist()[0]))
                if held:
                    yield pa.record_batch([
                        np.repeat([h[0] for h in held], [len(h[1]) for h in held]),
                        np.concatenate([h[1] for h in held]),
                        np.concatenate([(h[2] >> 63).astype(np.int64) for h in held]),
                        np.concatenate([(h[2] & LOWER).astype(np.int64) for h in held])], schema=schema)

    return run
