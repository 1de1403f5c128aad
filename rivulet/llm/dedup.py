"""Exact deduplication: radix tries whose end nodes hold the owner of each text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rivulet.llm.common import SLICE_BYTES, arrow_schema, as_rows, ascii_lower

OWNERS = "size bigint, sha binary, text binary, owner bigint, copies bigint"


class RadixTrie:
    """Compressed trie over byte strings; an end node holds the largest id and the copies.

    A node is [label, children by first byte, owner, copies]; copies is 0 on inner nodes.
    """

    def __init__(self) -> None:
        self.root: list = [b"", {}, 0, 0]
        self.held = 0

    def insert(self, key: bytes, owner: int, copies: int) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node[2] = max(node[2], owner) if node[3] else owner
                node[3] += copies
                return
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = [key[at:], {}, owner, copies]
                self.held += len(key) - at
                return
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            common = _common(label, key, at)
            split = [label[:common], {label[common]: child}, 0, 0]
            child[0] = label[common:]
            node[1][key[at]] = split
            node, at = split, at + common

    def drain(self) -> Iterator[tuple[bytes, int, int]]:
        """Gives every text with its owner and copies, and empties the trie."""
        stack = [(b"", self.root)]
        while stack:
            prefix, node = stack.pop()
            prefix += node[0]
            if node[3]:
                yield prefix, node[2], node[3]
            stack.extend((prefix, child) for child in node[1].values())
        self.root, self.held = [b"", {}, 0, 0], 0


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key`` from ``at``, by halving."""
    low, high = 1, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[:middle] == key[at:at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 held_bytes: int = 6 << 20) -> DataFrame:
    """Groups of equal texts, one row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty. Of equal
    texts the row with the largest id stays. ``group_size`` counts rows; rows that repeat an id
    share its decision, and an id may own several texts. Rows without id are counted and never
    kept unless all of their group are without (then keep_id is null and kept is false for all).

    Each task first puts the texts it reads into a trie, so a text that fills a third of the table
    leaves a task a few times at most. Owners then meet by length and content hash, ordered by
    both, and the full byte strings go into the trie of their partition. The trie is filled
    subtree by subtree: once a length and hash are past, or ``held_bytes`` are held between two
    hashes, what it holds is written out and dropped, so memory stays bounded by a few texts.
    The digest that joins rows to their owner is SHA-256 of the whole text.
    """
    source = docs.select(F.col(id_column).cast("bigint").alias("id"),
                         F.col(text_column).cast("string").alias("text"))
    local = source.mapInArrow(_collapser(held_bytes), OWNERS)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owners = (local.repartition(parts, "size", "sha").sortWithinPartitions("size", "sha")
              .mapInArrow(_owner_finder(held_bytes), "sha binary, owner bigint, copies bigint"))
    marked = source.mapInArrow(_digests, "id bigint, sha binary")
    return marked.join(owners, "sha").select(
        F.col("id").alias(id_column), F.when(F.col("owner") > _NO_ID, F.col("owner")).alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.coalesce(F.col("id") == F.col("owner"), F.lit(False)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


_NO_ID = -(1 << 63)


def _normal(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    start = 0
    width = max(1, batch.nbytes // max(1, batch.num_rows))
    step = max(1, SLICE_BYTES // width)
    while start < batch.num_rows:
        part = batch.slice(start, step)
        lowered = pc.ascii_lower(pc.fill_null(part.column("text"), "")).cast(pa.binary())
        ids = pc.fill_null(part.column("id"), _NO_ID)
        yield from zip(ids.to_pylist(), lowered.to_pylist())
        start += step


def _collapser(held_bytes: int):
    """Equal texts of a task become one row; what is held is written out when it grows too large."""
    schema = arrow_schema(OWNERS)

    def emit(trie: RadixTrie) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for text, owner, copies in trie.drain():
            rows.append((len(text), hashlib.sha256(text).digest(), text, owner, copies))
            size += len(text)
            if size >= SLICE_BYTES:
                yield _rows(schema, rows)
                rows, size = [], 0
        if rows:
            yield _rows(schema, rows)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, seen = RadixTrie(), 0
        for batch in source:
            for owner, text in _normal(batch):
                trie.insert(text, owner, 1)
                seen += 1
                if trie.held >= held_bytes:
                    yield from emit(trie)
        yield from emit(trie)

    return run


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)],
                           schema=schema)


def _owner_finder(held_bytes: int):
    schema = arrow_schema("sha binary, owner bigint, copies bigint")

    def emit(trie: RadixTrie) -> Iterator[pa.RecordBatch]:
        rows = [(hashlib.sha256(text).digest(), owner, copies) for text, owner, copies in trie.drain()]
        if rows:
            yield _rows(schema, rows)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last = RadixTrie(), None
        for batch in source:
            columns = [batch.column(n) for n in ("sha", "owner", "copies")]
            texts = batch.column("text")
            for i, (sha, owner, copies) in enumerate(zip(*[c.to_pylist() for c in columns])):
                if sha != last and trie.held >= held_bytes:
                    yield from emit(trie)
                last = sha
                trie.insert(texts[i].as_py(), owner, copies)
        yield from emit(trie)

    return run


def _digests(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        shas = [hashlib.sha256(text).digest() for _, text in _normal(batch)]
        yield pa.record_batch([batch.column("id"), pa.array(shas, type=pa.binary())],
                              names=["id", "sha"])


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one for each text, all columns as they were.

    Rows that repeat the owner's id with the same text are told apart no further: one of them
    stays, the one whose other columns sort first. Rows without id cannot be chosen from and all stay.
    """
    lowered = ascii_lower(F.coalesce(F.col(text_column), F.lit("")))
    kept = (exact_groups(docs, id_column, text_column).where("kept")
            .select(F.col(id_column).alias("_id"), F.col("text_sha256").alias("_sha")))
    marked = as_rows(docs, _id=F.col(id_column).cast("bigint"), _sha=F.sha2(lowered.cast("binary"), 256))
    first = W.partitionBy("_id", "_sha").orderBy(F.to_json("_row"))
    stay = (marked.join(kept, ["_id", "_sha"], "left_semi")
            .withColumn("_n", F.row_number().over(first)).where("_n = 1"))
    return stay.select("_row.*").unionByName(docs.where(F.col(id_column).isNull()))
