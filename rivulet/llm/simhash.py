"""Near-duplicate groups: 64-bit fingerprints linked by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_schema, as_rows, texts_of, written

BITS = 64
#: Fingerprints that a task compares with each other; larger buckets are split by further masks.
BUCKET = 4096


def fingerprint(text: str, words_per_shingle: int = 4, seed: int = 42) -> int:
    """Majority bits over the XXH64 values of all word shingles; 0 for a text without words."""
    # bytes.lower() changes A-Z only, bytes.split() cuts at 0x20 and 0x09-0x0D only.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = words_per_shingle
    if len(words) <= n:
        values = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        values = [digest(join(s), seed) for s in zip(*[words[i:] for i in range(n)])]
    ones = np.zeros(BITS, dtype=np.int64)
    hashes = np.array(values, dtype="<u8")
    for at in range(0, len(hashes), 1 << 15):
        rows = hashes[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def covering_masks(radius: int, positions: list[int]) -> list[int]:
    """2^(radius+1) - 1 masks over some bit positions that cover every set of ``radius`` of them.

    Each position carries a nonzero vector of radius+1 bits, and mask v keeps the positions whose
    vector has an odd product with v. At most ``radius`` vectors cannot span radius+1 dimensions,
    so some v is orthogonal to them all: two fingerprints that differ at no more than ``radius``
    positions agree on everything that this mask keeps.
    """
    size = (1 << (radius + 1)) - 1
    vectors = {p: (i * 11) % size + 1 for i, p in enumerate(positions)}
    return [sum(1 << p for p, x in vectors.items() if (x & v).bit_count() & 1)
            for v in range(1, size + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 words_per_shingle: int = 4) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row."""
    schema = arrow_schema("id bigint, fp bigint")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = np.array([fingerprint(t, words_per_shingle)
                              for t in texts_of(batch.column("text"))], dtype=np.uint64)
            yield pa.record_batch([batch.column("id"), pa.array(found.view(np.int64))], schema=schema)

    return docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(run, "id bigint, fp bigint")


def near_links(prints: DataFrame, radius: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Links a, b that connect exactly what pairs within ``radius`` differing bits connect.

    ``prints`` has distinct fingerprints (fp). Every fingerprint goes to one bucket per covering
    mask; fingerprints alone in a bucket go no further. A bucket gives a spanning forest of its
    pairs within the radius, never all pairs. A bucket above ``bucket`` fingerprints is dealt
    again by masks over the bits that its mask left out; these halve each time and fingerprints
    are distinct, so buckets come below the bound after a few rounds.
    """
    spark = prints.sparkSession
    family = [(0, i + 1, _signed(m)) for i, m in enumerate(covering_masks(radius, list(range(BITS))))]
    placed = prints.select("fp", F.lit(0).cast("bigint").alias("path"))
    links: DataFrame | None = None
    while True:
        masks = spark.createDataFrame(family, "path bigint, i bigint, mask bigint")
        per_path = masks.groupBy("path").agg(F.collect_list(F.struct("i", "mask")).alias("m"))
        if len({p for p, _, _ in family}) == 1:  # the first round needs no join
            options = F.array(*[F.struct(F.lit(i).cast("bigint").alias("i"),
                                         F.lit(m).cast("bigint").alias("mask")) for _, i, m in family])
            dealt = placed.where(F.col("path") == family[0][0]).select(
                "fp", "path", F.explode(options).alias("m"))
        else:
            dealt = placed.join(F.broadcast(per_path), "path").select(
                "fp", "path", F.explode("m").alias("m"))  # at most 31 masks for each of 961 paths
        dealt = dealt.select("fp", (F.col("path") * 64 + F.col("m.i")).alias("path"),
                             (F.col("m.mask") != 0).alias("cut"),
                             F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"))
        shared = dealt.groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1")
        # Never broadcast: Spark sizes exploded rows as the rows before, 31 times too low, and would send them to the driver.
        rows = written(dealt.join(shared.hint("merge"), ["path", "key"]), "simhash-buckets")
        last = (F.col("n") <= bucket) | ~F.col("cut")
        found = (rows.where(last).repartition("path", "key")
                 .sortWithinPartitions("path", "key", "fp")
                 .mapInArrow(_forests(radius), "a bigint, b bigint"))
        links = found if links is None else links.unionByName(found)
        hot = rows.where(~last)
        paths = [r["path"] for r in hot.select("path").distinct().collect()]  # masks, not keys
        if not paths:
            return links.distinct()
        family = [(p, i + 1, _signed(m)) for p in paths
                  for i, m in enumerate(covering_masks(radius, _free_positions(radius, p)))]
        placed = hot.select("fp", "path")


def _free_positions(radius: int, path: int) -> list[int]:
    """The bit positions that the masks of a path leave out."""
    steps = []
    while path:
        path, i = divmod(path, 64)
        steps.append(i - 1)
    free = list(range(BITS))
    for i in reversed(steps):
        mask = covering_masks(radius, free)[i]
        free = [p for p in free if not mask >> p & 1]
    return free


def spanning_forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join the same fingerprints as all pairs within ``radius`` differing bits do."""
    rest, links = prints.copy(), []
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            here = reached.pop()
            near = np.bitwise_count(rest ^ here) <= radius
            if near.any():
                links += [(int(here), int(x)) for x in rest[near]]
                reached += list(rest[near])
                rest = rest[~near]
    return links


def _forests(radius: int):
    schema = arrow_schema("a bigint, b bigint")

    def emit(parts: list[np.ndarray]) -> list[tuple[int, int]]:
        return spanning_forest(np.concatenate(parts).view(np.uint64), radius)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts = None, []
        for batch in source:
            if not batch.num_rows:
                continue
            path, key, fp = (batch.column(n).to_numpy() for n in ("path", "key", "fp"))
            cuts = np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1])) + 1
            links: list[tuple[int, int]] = []
            for first, stop in zip([0, *cuts], [*cuts, len(path)]):
                if parts and (path[first], key[first]) != last:
                    links += emit(parts)
                    parts = []
                last = (path[first], key[first])
                parts.append(fp[first:stop])
            if links:
                yield _links(links)
        if parts and (links := emit(parts)):
            yield _links(links)

    def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array(links, dtype=np.uint64).view(np.int64)
        return pa.record_batch([both[:, 0], both[:, 1]], schema=schema)

    return run


def components(links: DataFrame) -> DataFrame:
    """node, root: for every linked node the smallest node that links reach.

    Rounds of large-star and small-star steps, each of which joins nodes with their smallest neighbour, so
    that no step gathers the neighbours of a node. Each round is written to the shared folder,
    and rounds end when no link changes.
    """
    a, b = F.col("a"), F.col("b")
    ordered = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = written(ordered.where("a <> b").distinct(), "components")
    before = None
    while True:
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("m", "a").alias("m"))
        large = (both.where("b > a").join(least, "a").select(b.alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(low, "a").select(b.alias("a"), F.col("m").alias("b"))
                 .where("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        edges = written(small, "components")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(a.alias("node"), b.alias("root"))
        before = state


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                radius: int = 4, words_per_shingle: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Texts are lower-cased (A-Z) and cut at ASCII white space; the fingerprint has the majority bit of
    the XXH64 (seed 42) of all shingles, repeats included. Fewer words than a shingle: the whole
    sequence is one; none (null and empty texts too): fingerprint zero, linked like any other.
    Fingerprints that differ in at most ``radius`` bits are linked, and component_id is the smallest
    id that links reach, the row's own included. Rows that repeat an id are in one group each by
    their text; rows without id take part and have no say in component_id.
    Copies meet as one fingerprint before any search, and a hot fingerprint only in the last join,
    where Spark splits it.
    """
    return _grouped(docs, id_column, text_column, radius, words_per_shingle, bucket).select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def _grouped(docs: DataFrame, id_column: str, text_column: str, radius: int, words_per_shingle: int = 4,
             bucket: int = BUCKET) -> DataFrame:
    """id, fp, root and component_id of every row; root is the group's smallest fingerprint.

    Groups that share a component_id, because an id owns several texts, differ in their root.
    """
    prints = written(fingerprints(docs, id_column, text_column, words_per_shingle), "simhash-prints")
    distinct = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = components(near_links(distinct.select("fp"), radius, bucket))
    member = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = member.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(groups, "fp").select("id", "fp", "root", "component_id")


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               radius: int = 4) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group: the one with the group's smallest id.

    All columns stay as they were. Of the group's rows that repeat that id the one whose other columns
    sort first stays; rows of that id in other groups have no part in it, and an id with several texts
    may stand for several groups. Rows without id cannot be chosen from and all stay.
    """
    @F.arrow_udf("bigint")
    def printed(text: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t) for t in texts_of(text)], dtype=np.uint64)
        return pa.array(found.view(np.int64))

    chosen = (_grouped(docs, id_column, text_column, radius).where("id = component_id")
              .select(F.col("id").alias("_id"), F.col("fp").alias("_fp"), F.col("root").alias("_root")).distinct())
    # Not deterministic for the optimizer only: it would compute the fingerprint again in a filter.
    text_print = printed.asNondeterministic()(F.col(text_column).cast("string"))
    marked = as_rows(docs, _id=F.col(id_column).cast("bigint"), _fp=text_print)
    first = W.partitionBy("_root").orderBy(F.to_json("_row"))
    stay = (marked.join(chosen, ["_id", "_fp"])
            .withColumn("_n", F.row_number().over(first)).where("_n = 1"))
    return stay.select("_row.*").unionByName(docs.where(F.col(id_column).isNull()))
