"""Near-duplicate classes by SetSketch: banded registers, a likelihood test, exact verification."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_schema, texts_of, written
from rivulet.llm.simhash import components

#: Registers of a sketch, as bands of ROWS. A pair at the similarity of 0.85 shares no band with a
#: probability of (1 - 0.85^5)^26 = 2.4e-7.
BANDS, ROWS = 26, 5
REGISTERS = BANDS * ROWS
#: Register values: floor(1 - log_BASE(least exponential value of rate RATE)), kept in 0 to LIMIT + 1.
BASE, RATE, LIMIT = 1.2, 20.0, 254
#: A pair is dismissed without verification only where some similarity below the threshold explains its
#: registers better by this difference of log likelihoods (about five standard errors).
DOUBT = 12.5
#: Shingles whose hashes are spread over all registers at once.
CHUNK = 512
#: Sets that one task holds together, by their shingles and MEMBER for each; larger clusters are cut into parts.
PART, MEMBER = 2_000_000, 250
#: Sketches of one bucket that a task compares with each other.
BUCKET = 4096

_SEED = np.random.default_rng(20_240)
_XOR = _SEED.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_ODD = _SEED.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) << np.uint32(1) | np.uint32(1)
_SPACE = np.empty((CHUNK, REGISTERS), dtype=np.uint32)
#: c * log(c / REGISTERS) for counts of registers.
_ENTROPY = np.array([0.0] + [c * np.log(c / REGISTERS) for c in range(1, REGISTERS + 1)])
_STEPS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingles_of(text: str, words_per_shingle: int = 3) -> np.ndarray:
    """The distinct word shingles of a text, as sorted 64-bit hashes."""
    # bytes.lower() changes A-Z only, bytes.split() cuts at 0x20 and 0x09-0x0D only.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    width = min(len(words), words_per_shingle)
    if not width:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.array(list(map(xxhash.xxh64_intdigest, words)), dtype=np.uint64)
    count = len(words) - width + 1
    mixed = np.full(count, width, dtype=np.uint64)
    for i in range(width):
        mixed = (mixed ^ hashes[i:i + count]) * _STEPS[i % 3]
        mixed ^= mixed >> np.uint64(29)
    mixed.sort()
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of a set. A register holds the least of an exponentially distributed hash over
    the elements, on a logarithmic scale and cut off at both ends; an empty set has zeros."""
    if not len(shingles):
        return np.zeros(REGISTERS, dtype=np.uint8)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, dtype=np.uint32)
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(shingles), CHUNK):
        # The order of uniform hashes is the order of their exponentials, so the minimum is taken first.
        part = folded[at:at + CHUNK]
        spread = np.bitwise_xor(part[:, None], _XOR, out=_SPACE[:len(part)])
        np.multiply(spread, _ODD, out=spread)
        np.minimum(least, spread.min(axis=0), out=least)
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0 ** 32) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint8)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.maximum(a, b)


def _chance(x: np.ndarray) -> np.ndarray:
    """Probability that a register is strictly larger, for the share x of elements that only its set has."""
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(similarity: float, size_a: int, sizes_b: np.ndarray, above: np.ndarray, below: np.ndarray,
                   equal: np.ndarray) -> np.ndarray:
    """Joint log likelihood of the registers of pairs (a, b): how many of a's are above, below, equal to b's."""
    share = size_a / (size_a + sizes_b)
    similarity = np.minimum(similarity, np.minimum(share / (1 - share), (1 - share) / share))
    more = _chance(np.maximum(share - (1 - share) * similarity, 1e-12))
    less = _chance(np.maximum((1 - share) - share * similarity, 1e-12))
    return above * np.log(more) + below * np.log(less) + equal * np.log(np.maximum(1 - more - less, 1e-12))


def plausible(own: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the other sketches may belong to sets similar to ``percent`` hundredths or more."""
    # |A and B| is at most the smaller size, |A or B| at least the larger one.
    open_ = 100 * np.minimum(size, sizes) >= percent * np.maximum(size, sizes)
    at = np.flatnonzero(open_)
    if not len(at):
        return open_
    rows, counts = others[at], sizes[at].astype(np.float64)
    above, below = (own > rows).sum(axis=1), (own < rows).sum(axis=1)
    equal = REGISTERS - above - below
    wanted = log_likelihood(percent / 100, size, counts, above, below, equal)
    # No similarity explains the registers better than their own frequencies do.
    doubtful = np.flatnonzero(_ENTROPY[above] + _ENTROPY[below] + _ENTROPY[equal] - wanted > DOUBT)
    if len(doubtful):
        seen = counts[doubtful], above[doubtful], below[doubtful], equal[doubtful]
        best = np.max([log_likelihood(s, size, *seen) for s in np.linspace(0.0, percent / 100, 13)[:-1]], axis=0)
        open_[at[doubtful]] = best - wanted[doubtful] <= DOUBT
    return open_


def similar(own: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Exact test 100 * |A and B| >= percent * |A or B| of one set against others."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    common = np.add.reduceat((own[place] == flat).astype(np.int64), starts)
    return 100 * common >= percent * (len(own) + sizes - common)


class Members:
    """Sketches, sizes and, where exact tests are wanted, sets of nodes that one task compares."""

    def __init__(self, nodes: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, sets: list[np.ndarray] | None,
                 percent: int) -> None:
        self.nodes, self.sizes, self.sketches, self.sets, self.percent = nodes, sizes, sketches, sets, percent

    def linked(self, here: int, rest: np.ndarray) -> np.ndarray:
        """Which of the rest are linked with one member: by full sets, or by sketches alone."""
        near = plausible(self.sketches[here], int(self.sizes[here]), self.sketches[rest], self.sizes[rest], self.percent)
        if self.sets is not None and near.any():
            at = np.flatnonzero(near)
            near[at] = similar(self.sets[here], [self.sets[i] for i in rest[at]], self.percent)
        return near

    def forest(self) -> list[tuple[int, int]]:
        """Links that join the same nodes as all links between them do; never all pairs."""
        rest, links = np.arange(len(self.nodes)), []
        while len(rest):
            reached, rest = [rest[0]], rest[1:]
            while reached and len(rest):
                here = reached.pop()
                near = self.linked(here, rest)
                links += [(int(self.nodes[here]), int(self.nodes[i])) for i in rest[near]]
                reached += list(rest[near])
                rest = rest[~near]
        return links

    def across(self, lesser: np.ndarray, roots: np.ndarray) -> list[tuple[int, int]]:
        """Links between marked members and those of other roots, one for each root that a member reaches."""
        links = []
        for here in np.flatnonzero(lesser):
            other = np.flatnonzero(roots != roots[here])
            if len(other):
                found = other[self.linked(here, other)]
                _, first = np.unique(roots[found], return_index=True)
                links += [(int(self.nodes[here]), int(self.nodes[i])) for i in found[first]]
        return links


def _grouped(source: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[dict[str, list]]:
    """Runs of rows with equal keys, as columns; batches are sorted by the keys."""
    held: dict[str, list] = {}
    last = None
    for batch in source:
        rows = batch.to_pydict()
        marks = list(zip(*[rows[k] for k in keys]))
        start = 0
        for stop in range(1, len(marks) + 1):
            if stop < len(marks) and marks[stop] == marks[start]:
                continue
            if held and marks[start] != last:
                yield held
                held = {}
            last = marks[start]
            for name, column in rows.items():
                held.setdefault(name, []).extend(column[start:stop])
            start = stop
    if held:
        yield held


def _members(rows: dict[str, list], percent: int, exact: bool) -> tuple[Members, np.ndarray]:
    """The members of a run, each node once, and the places of their rows."""
    nodes, first = np.unique(np.array(rows["node"], dtype=np.int64), return_index=True)
    pick = lambda name: [rows[name][i] for i in first]
    sketches = np.frombuffer(b"".join(pick("sketch")), dtype=np.uint8).reshape(-1, REGISTERS)
    sets = [np.frombuffer(s, dtype=np.uint64) for s in pick("shingles")] if exact else None
    return Members(nodes, np.array(pick("size"), dtype=np.int64), sketches, sets, percent), first


def _link_batch(links: list[tuple[int, int]], schema: pa.Schema) -> pa.RecordBatch:
    both = np.array(links, dtype=np.int64).reshape(-1, 2)
    return pa.record_batch([both[:, 0], both[:, 1]], schema=schema)


def _forests(keys: tuple[str, ...], percent: int, exact: bool):
    schema = arrow_schema("a bigint, b bigint")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(source, keys):
            links = _members(rows, percent, exact)[0].forest()
            if links:
                yield _link_batch(links, schema)

    return run


def _crossings(keys: tuple[str, ...], percent: int):
    schema = arrow_schema("a bigint, b bigint")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(source, keys):
            members, first = _members(rows, percent, True)
            lesser = dict.fromkeys(n for n, x in zip(rows["node"], rows["lesser"]) if x)
            marked = np.array([int(n) in lesser for n in members.nodes])
            links = members.across(marked, np.array([rows["root"][i] for i in first]))
            if links:
                yield _link_batch(links, schema)

    return run


def marks(docs: DataFrame, id_column: str, text_column: str, words_per_shingle: int) -> DataFrame:
    """id, h (hash of the text), size of the set, digest of the set in two halves, sketch of every row."""
    schema = arrow_schema("id bigint, h bigint, size bigint, d1 bigint, d2 bigint, sketch binary")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sizes, halves, sketches = [], [], []
            for text in texts_of(batch.column("text")):
                found = shingles_of(text, words_per_shingle)
                sizes.append(len(found))
                halves.append(struct.unpack("<qq", xxhash.xxh3_128_digest(found.tobytes())))
                sketches.append(sketch(found).tobytes())
            d1, d2 = zip(*halves) if halves else ((), ())
            yield pa.record_batch([batch.column("id"), batch.column("h"), pa.array(sizes, type=pa.int64()),
                                   pa.array(d1, type=pa.int64()), pa.array(d2, type=pa.int64()),
                                   pa.array(sketches, type=pa.binary())], schema=schema)

    return _keyed(docs, id_column, text_column).mapInArrow(
        run, "id bigint, h bigint, size bigint, d1 bigint, d2 bigint, sketch binary")


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(f"`{text_column}`").cast("string")
    return docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def buckets(classes: DataFrame) -> DataFrame:
    """key, node: a row for each band of every class; the key is the hash of the band's registers."""
    schema = arrow_schema("key bigint, node bigint")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8)
            values = values.reshape(-1, BANDS, ROWS).astype(np.uint64)
            key = np.tile(np.arange(BANDS, dtype=np.uint64), (len(values), 1))
            for r in range(ROWS):
                key = (key ^ (values[:, :, r] + np.uint64(r << 8))) * _STEPS[r % 3]
                key ^= key >> np.uint64(31)
            nodes = np.repeat(batch.column("node").to_numpy(), BANDS)
            yield pa.record_batch([key.ravel().view(np.int64), nodes], schema=schema)

    return classes.select("node", "sketch").mapInArrow(run, "key bigint, node bigint")


def class_links(docs: DataFrame, classes: DataFrame, id_column: str, text_column: str, percent: int,
                words_per_shingle: int, bucket: int = BUCKET, part: int = PART) -> DataFrame:
    """Links a, b between classes (node, id, h, size, sketch) that connect what all links in buckets connect.

    Classes that share a band meet in a bucket. Sketches alone first form a forest of the plausible
    pairs of each bucket (a bucket above ``bucket`` classes counts as all plausible), whose
    components are clusters. Only classes in clusters have their texts read again, and each full
    set goes to one task, with its cluster: there a forest of verified links is formed. A cluster above
    ``part`` shingles is cut into parts by hash first. Of its buckets that still hold several
    components, the members outside the most frequent one are then verified against all others of the
    bucket, in pairs of parts, so that every pair of a bucket is either connected or verified.
    """
    dealt = buckets(classes)
    shared = dealt.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("least")).where("members > 1")
    met = written(dealt.join(shared, "key"), "setsketch-buckets")
    plain = ["node", "size", "sketch"]
    hot = met.where(F.col("members") > bucket).select(F.col("node").alias("a"), F.col("least").alias("b"))
    guessed = (met.where(F.col("members") <= bucket).join(classes.select(*plain), "node")
               .select("key", *plain).repartition("key").sortWithinPartitions("key", "node")
               .mapInArrow(_forests(("key",), percent, False), "a bigint, b bigint"))
    cluster = components(guessed.unionByName(hot))
    weights = cluster.select(F.col("root").alias("node"), "root").distinct().unionByName(cluster).join(
        classes.select("node", "size"), "node").groupBy("root").agg(F.sum(F.col("size") + MEMBER).alias("weight"))
    members = cluster.unionByName(cluster.select(F.col("root").alias("node"), "root").distinct())
    weights = written(weights.withColumn("parts", F.ceil(F.col("weight") / part).cast("int")), "setsketch-weights")
    sets = written(_full_sets(docs, classes, members, id_column, text_column, words_per_shingle)
                   .join(weights.select("root", "parts"), "root"), "setsketch-sets")
    keys = ("root", "part")
    placed = sets.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    links = written(placed.select(*keys, *plain, "shingles").repartition(*keys).sortWithinPartitions(*keys, "node")
                    .mapInArrow(_forests(keys, percent, True), "a bigint, b bigint"), "setsketch-links")
    if not weights.where("parts > 1").limit(1).count():
        return links
    return links.unionByName(_between_parts(sets.where("parts > 1"), met, links, percent, part))


def _full_sets(docs: DataFrame, classes: DataFrame, members: DataFrame, id_column: str, text_column: str,
               words_per_shingle: int) -> DataFrame:
    """node, root, size, sketch, shingles of the classes in clusters, from the text of one of their rows."""
    wanted = members.join(classes, "node").select("node", "root", "size", "sketch", F.col("id").alias("_id"),
                                                  F.col("h").alias("_h"))
    found = _keyed(docs, id_column, text_column).join(
        wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")))
    schema = arrow_schema("node bigint, root bigint, size bigint, sketch binary, shingles binary")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in source:
            # Rows that repeat an id and text come once from each task; readers take each node once.
            fresh = [i for i, n in enumerate(batch.column("node").to_pylist()) if not (n in seen or seen.add(n))]
            batch = batch.take(pa.array(fresh, type=pa.int64()))
            sets = [shingles_of(t, words_per_shingle).tobytes() for t in texts_of(batch.column("text"))]
            yield pa.record_batch([*(batch.column(c) for c in ("node", "root", "size", "sketch")),
                                   pa.array(sets, type=pa.binary())], schema=schema)

    return found.select("node", "root", "size", "sketch", "text").mapInArrow(
        run, "node bigint, root bigint, size bigint, sketch binary, shingles binary")


def _between_parts(sets: DataFrame, met: DataFrame, links: DataFrame, percent: int, part: int) -> DataFrame:
    """Links of clusters cut into parts: what differs from a bucket's main component meets all others."""
    joined = components(links)
    known = (sets.dropDuplicates(["node"]).drop("root", "parts").join(joined, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    known = written(known, "setsketch-known")
    inside = written(met.select("key", "node").join(known.select("node", "root", "size"), "node"), "setsketch-inside")
    by_root = inside.groupBy("key", "root").agg(F.count("*").alias("m"), F.sum(F.col("size") + MEMBER).alias("w"))
    main = by_root.groupBy("key").agg(
        F.max_by("root", F.struct("m", "root")).alias("main"), F.count("*").alias("roots"), F.sum("w").alias("all"),
        (F.sum("w") - F.max_by("w", F.struct("m", "root"))).alias("rest"))
    open_ = inside.join(written(main.where("roots > 1"), "setsketch-open"), "key").select(
        "key", "node", "root", (F.col("root") != F.col("main")).alias("lesser"),
        F.ceil(F.col("all") * 2 / part).cast("int").alias("across"), F.ceil(F.col("rest") * 2 / part).cast("int").alias("down"))
    h = F.xxhash64(F.lit(7), F.col("node"))
    row, column = F.pmod(h, F.col("down")).cast("int"), F.pmod(h, F.col("across")).cast("int")
    # A lesser member stands in its row part against every column; every member in its column against every row.
    lesser = open_.where("lesser").select("key", "node", "root", "lesser", row.alias("i"), F.explode(
        F.sequence(F.lit(0), F.col("across") - 1)).alias("j"))
    every = open_.select("key", "node", "root", F.lit(False).alias("lesser"), F.explode(
        F.sequence(F.lit(0), F.col("down") - 1)).alias("i"), column.alias("j"))
    keys = ("key", "i", "j")
    return (lesser.unionByName(every).join(known.select("node", "size", "sketch", "shingles"), "node")
            .repartition(*keys).sortWithinPartitions(*keys, "node")
            .mapInArrow(_crossings(keys, percent), "a bigint, b bigint"))


def near_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 85,
                 words_per_shingle: int = 3, bucket: int = BUCKET, part: int = PART) -> DataFrame:
    """id, n_shingles, component_id and kept of every row of ``docs``.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a document's set holds its distinct word
    shingles, or with fewer words the whole sequence. Documents are linked where 100 * |A and B| >=
    percent * |A or B|, verified on full sets (of 64-bit shingle hashes); component_id is the
    smallest id that links reach, the row's own included, and the row with that id is kept. Equal
    sets form one class before any search, so groups of copies cost one row. Texts without words
    (null too) are linked with nothing. Rows that repeat an id are linked by their own texts; rows
    without id take part, have no say in component_id and are never kept; an empty table gives no
    rows; other columns are ignored.
    Candidates are pairs that share one of the bands of registers. Per pair at the threshold the chance
    to share none is 2.4e-7, and the likelihood test dismisses with a similar chance.
    """
    found = written(marks(docs, id_column, text_column, words_per_shingle), "setsketch-marks")
    classes = found.where("size > 0").groupBy("d1", "d2").agg(
        F.min("id").alias("first"), F.min(F.struct("id", "h")).alias("one"), F.min("size").alias("size"),
        F.min("sketch").alias("sketch"))
    classes = written(classes.select("d1", "d2", "first", "one.id", "one.h", "size", "sketch",
                                     F.monotonically_increasing_id().alias("node")), "setsketch-classes")
    links = class_links(docs, classes, id_column, text_column, percent, words_per_shingle, bucket, part)
    joined = components(links)
    member = classes.select("d1", "d2", "node", "first").join(joined, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    # Written, so that the join has an exchange on both sides and Spark can split a large group.
    least = written(member.groupBy("root").agg(F.min("first").alias("component_id")), "setsketch-least")
    groups = member.join(least, "root").select("d1", "d2", "component_id")
    linked = found.where("size > 0").join(groups, ["d1", "d2"]).select("id", "size", "component_id")
    alone = found.where("size = 0").select("id", "size", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_column), F.col("size").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
