"""Merkle manifest of a table: trees per group, upper proofs by butterfly exchange between partitions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_schema, batches, written

#: Hex digits of one digest.
HEX = 64
FOUND = ("id bigint, leaf string, subroot string, root string, proof_sha256 string, "
         "folded_root string, verified boolean")
ROWS = "array<struct<pos: bigint, id: bigint, leaf: string, other: string>>"


def leaf_hash(columns: Sequence[Column]) -> Column:
    """SHA-256 over the columns in turn: ``-`` for null, else the UTF-8 length, a colon and the value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def numbered(df: DataFrame, order: Sequence[str], within: str, name: str) -> DataFrame:
    """``df`` with ``pos`` (from 0, by ``order`` inside each value of ``within``) and ``n`` (rows of that value).

    ``order`` starts with ``within`` or holds a constant there. Rows are dealt by ranges of the
    order, so that a value with a third of all rows spreads over many tasks; only the number of
    rows of each value in each range is then summed up.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                     .withColumn("_at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy(within, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    ranges = W.partitionBy(within)
    runs = runs.select(within, "_part", "_first", F.sum("_n").over(ranges).alias("n"),
                       (F.sum("_n").over(ranges.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(runs, [within, "_part"]).withColumn(
        "pos", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_before")


def _digest(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, ""), 256)


def butterfly(nodes: DataFrame, fanout: int = 16) -> DataFrame:
    """Root and upper proof of every partition, by rounds in which groups of ``fanout`` partitions swap roots.

    ``nodes`` has grp, blk (0 to n-1 inside grp), n and h, the root of what the partition holds.
    In round r a partition knows the root of the aligned group of fanout^r partitions it is in. It
    sends that root to its counterparts in the neighbouring groups of the same parent; each
    receives one root per group, keeps the others as its siblings of this level and hashes the parent
    itself, like all of its counterparts do. So every partition ends with all its siblings up to the
    root, and nothing has to be handed down. In a last group that is not full, its members share the
    places of the missing ones. Returns grp, blk, n, root and proof (siblings' digests of each
    level as one text, lowest level first).
    """
    state = nodes.select("grp", "blk", "n", "h", F.array().cast("array<string>").alias("proof"))
    most = nodes.agg(F.max("n")).first()[0] or 0
    width = 1
    while width < most:
        at, n = F.col("blk"), F.col("n")
        groups = F.ceil(n / width)  # nodes of this level; one is the root
        own = F.floor(at / width)

        def held(group: Column, width: int = width) -> Column:
            return F.least(F.lit(width).cast("bigint"), n - group * width)

        parent = F.floor(own / fanout)
        sent = state.where(groups > 1).select(
            "grp", "blk", "n", "h", "proof", own.alias("own"), (at % width).alias("low"),
            held(own).alias("step"),
            F.explode(F.sequence(parent * fanout, F.least((parent + 1) * fanout, groups) - 1)).alias("to_group"))
        room = held(F.col("to_group"))
        sent = sent.where(F.col("low") < room).select(
            "grp", "blk", "n", "h", "proof", "own", "to_group",
            F.explode(F.sequence("low", room - 1, "step")).alias("to_low"))
        to = F.col("to_group") * width + F.col("to_low")
        mine = F.when(to == F.col("blk"), F.struct("proof", "own"))
        met = sent.groupBy("grp", to.alias("blk"), "n").agg(
            F.sort_array(F.collect_list(F.struct(F.col("own").alias("g"), "h"))).alias("met"),  # at most ``fanout``
            F.max(mine).alias("mine"))
        siblings = F.array_join(F.transform(F.filter("met", lambda m: m["g"] != F.col("mine.own")),
                                            lambda m: m["h"]), "")
        climbed = met.select(
            "grp", "blk", "n", _digest(F.transform("met", lambda m: m["h"])).alias("h"),
            F.concat("mine.proof", F.array(siblings)).alias("proof"))
        state = written(state.where(groups <= 1).unionByName(climbed), "merkle-round")
        width *= fanout
    return state.withColumnRenamed("h", "root")


def manifest(docs: DataFrame, id_column: str = "doc_id", group_column: str = "source",
             hashed: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
             altered: dict[str, Column] | None = None, altered_where: Column | None = None,
             fanout: int = 16, block_levels: int = 3, with_proofs: bool = False) -> DataFrame:
    """Leaf, subroot of its group, root of the table and checked proof of every row.

    A leaf is the hash of the ``hashed`` columns. Leaves of a group ascend by id (rows that repeat an id
    by leaf; null ids first), and every ``fanout`` consecutive nodes become one until one is left; a
    last run may be shorter, down to one node, and a lone leaf is itself the subroot. The subroots in
    byte order of their group (null first) give the root likewise. ``proof_sha256`` is the hash of all
    siblings on the way up. ``altered`` replaces columns where ``altered_where`` holds, as a test
    of the proofs: ``folded_root`` is recomputed from that leaf and the original siblings, and
    ``verified`` says whether it equals the root. With ``with_proofs`` the siblings follow as an
    array, one text of digests per level, and ``places``, the own place in the run of each level.

    Leaves are numbered by ranges of (group, id) and cut into aligned blocks of fanout^block_levels
    leaves; a block knows its lower levels, and blocks exchange the upper ones (``butterfly``), as do
    groups after them. Only digests travel, never texts, and no task holds more than one block of
    a group, however large the group is. Null, empty and long values are hashed whole; repeated
    rows are leaves each; an empty table gives no rows; other columns are ignored.
    """
    columns = [F.col(f"`{c}`") for c in hashed]
    group = F.col(f"`{group_column}`").cast("string")
    changed = [(altered or {}).get(c, F.col(f"`{c}`")) for c in hashed]
    where = F.lit(False) if altered_where is None else F.coalesce(altered_where, F.lit(False))
    # 's' before a group's name keeps the byte order and puts null before all of them.
    leaves = written(docs.select(
        F.coalesce(F.concat(F.lit("s"), group), F.lit("")).alias("grp"),
        F.col(f"`{id_column}`").cast("bigint").alias("id"), leaf_hash(columns).alias("leaf"),
        F.when(where, leaf_hash(changed)).alias("other"),
        F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    block = fanout ** block_levels
    placed = numbered(leaves, ["grp", "id", "leaf", "row"], "grp", "merkle-sorted")
    rows = F.sort_array(F.collect_list(F.struct(F.col("pos").cast("bigint"), "id", "leaf", "other"))).alias("rows")  # one block at most
    blocks = placed.groupBy("grp", "n", F.floor(F.col("pos") / block).alias("blk")).agg(rows)
    blocks = written(blocks.select("grp", "n", "blk", "rows").mapInArrow(
        _roots(fanout, block_levels), f"grp string, n bigint, blk bigint, rows {ROWS}, h string"), "merkle-blocks")

    lower = butterfly(blocks.select("grp", "blk", F.ceil(F.col("n") / block).alias("n"), "h"), fanout)
    tops = lower.where("blk = 0").select(F.lit(0).alias("all"), F.col("grp").alias("name"), F.col("root").alias("h"))
    upper = _over_groups(tops, fanout)
    above = lower.withColumnsRenamed({"root": "subroot", "proof": "proof1"}).drop("n").join(upper, "grp")
    found = FOUND + (", proof array<string>, places array<int>" if with_proofs else "")
    out = blocks.drop("h").join(above, ["grp", "blk"]).select(
        "n", "blk", "rows", "subroot", "proof1", "root", "grp_at", "proof2").mapInArrow(
            _prover(fanout, block_levels, with_proofs), found)
    return out.withColumnRenamed("id", id_column)


def _over_groups(tops: DataFrame, fanout: int) -> DataFrame:
    """grp, grp_at (place among the groups), root and proof2 of every group."""
    ranked = written(numbered(tops, ["all", "name"], "all", "merkle-groups"), "merkle-ranked")
    done = butterfly(ranked.select(F.lit("").alias("grp"), F.col("pos").alias("blk"), "n", "h"), fanout)
    return ranked.select(F.col("name").alias("grp"), F.col("pos").alias("grp_at")).join(
        done.select(F.col("blk").alias("grp_at"), "root", F.col("proof").alias("proof2")), "grp_at")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _runs(nodes: list[str], fanout: int) -> list[str]:
    """The digests of each run of a level, as one text."""
    return ["".join(nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]


def _roots(fanout: int, block_levels: int):
    """Adds what a block's lower levels come to: one node, as a block has at most fanout^levels leaves."""
    def root(nodes: list[str], n: int) -> str:
        for level in range(block_levels):
            if n > fanout ** level:
                nodes = [_hash(t) for t in _runs(nodes, fanout)]
        return nodes[0]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = batch.column("rows")
            counts, ends = batch.column("n").to_pylist(), rows.offsets.to_pylist()
            leaves = rows.values.field("leaf")
            found = [root(leaves.slice(a, b - a).to_pylist(), n) for n, a, b in zip(counts, ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, type=pa.string())],
                                             [*batch.schema.names, "h"])

    return run


def _prover(fanout: int, block_levels: int, with_proofs: bool):
    """Proofs of the leaves of each block: its own levels, then those that the exchange brought."""
    schema = arrow_schema("id bigint, leaf string, subroot string, root string, proof_sha256 string, "
                          "folded_root string, verified boolean")
    if with_proofs:
        schema = schema.append(pa.field("proof", pa.list_(pa.string()))).append(
            pa.field("places", pa.list_(pa.int32())))

    def proofs(block: dict) -> Iterator[tuple]:
        rows = block["rows"]
        nodes, runs = [r["leaf"] for r in rows], []
        for level in range(block_levels):
            if block["n"] <= fanout ** level:
                break
            texts = _runs(nodes, fanout)
            runs.append(texts)
            nodes = [_hash(t) for t in texts]
        above = [(text, block["blk"] // fanout ** r % fanout) for r, text in enumerate(block["proof1"])]
        above += [(text, block["grp_at"] // fanout ** r % fanout) for r, text in enumerate(block["proof2"])]
        cut_above = [(t[:HEX * at], t[HEX * at:]) for t, at in above]
        for i, row in enumerate(rows):
            sides, own = [], i
            for texts in runs:
                own, at = divmod(own, fanout)
                sides.append((texts[own][:HEX * at], texts[own][HEX * (at + 1):]))
            sides += cut_above
            folded, whole = row["other"] or row["leaf"], hashlib.sha256()
            for left, right in sides:
                whole.update((left + right).encode())
                folded = _hash(left + folded + right)
            found = (row["id"], row["leaf"], block["subroot"], block["root"], whole.hexdigest(), folded,
                     folded == block["root"])
            yield found if not with_proofs else (
                *found, [a + b for a, b in sides], [len(a) // HEX for a, _ in sides])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i in range(batch.num_rows):
                yield from batches(schema, proofs(batch.slice(i, 1).to_pylist()[0]))

    return run
