"""Best-fit packing of tokenised documents into sequences, planned on the histogram of lengths."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_schema, batches, texts_of, written

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"
#: How the vocabulary's pre-tokenizer cuts a text; a fixed value that belongs to the file.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Distinct words whose ids a worker keeps; rarer ones are encoded again.
KEPT_WORDS = 800_000
#: A space with white space on both sides: there the pre-tokenizer looks beyond a word.
ODD_SPACE = re.compile(r"\s \s")
#: White space so long that ``tiktoken``, which looks ahead at its end, may exhaust its stack (at about a million).
LONG_SPACE = re.compile(r"\s{10000}")


class WordEncoder(dict):
    """Byte-level BPE ids of texts without added tokens; ids of a word once encoded are kept, up to a bound.

    The vocabulary's pre-tokenizer always cuts before a space that follows a character other than
    white space, and what comes after does not depend on what was before. So a text is cut there
    and its words are looked up; a text with a space amid white space is encoded whole, and one with
    very long white space by ``tokenizers``.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self._tool, self._path, self._slow = bpe_encoder(path), path, None

    def _encode(self, text: str) -> bytes:
        if LONG_SPACE.search(text):
            return array("I", self._whole().encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self._tool.encode_ordinary(text)).tobytes()

    def _whole(self):
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
        return self._slow

    def __missing__(self, word: str) -> bytes:
        ids = self._encode(" " + word)
        if len(self) < KEPT_WORDS and len(word) < 64:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        if ODD_SPACE.search(text):
            return self._encode(text)
        first, space, rest = text.partition(" ")
        if not space:
            return self._encode(first)
        return self._encode(first) + b"".join(map(self.__getitem__, rest.split(" ")))


def bpe_encoder(path: str):
    """Encoder for the vocabulary and the merge order of a byte-level tokenizer file.

    Ids follow the merge order in such files, so ids are ranks; a file where that fails is refused.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, cut = whole["model"], whole.get("pre_tokenizer") or {}
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        raise ValueError("the file cuts texts in another way than PATTERN")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"][a + b] for a, b in merges]
    if order != sorted(order):
        raise ValueError("ids do not follow the merge order")
    merged = {a + b for a, b in merges}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()
             if len(token) == 1 or token in merged}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class TextEncoder:
    """Ids of whole texts as the tokenizer file gives them: its added tokens have ids of their own.

    A text is cut at the added tokens, the leftmost first and of those the longest, and the parts
    between are encoded by themselves. A file whose added tokens take more than their own characters
    or need a normalized text is refused.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            added = [t for t in json.load(file).get("added_tokens") or [] if t["content"]]
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with options")
        self._words = WordEncoder(path)
        self._added = {t["content"]: t["id"].to_bytes(4, "little") for t in added}
        longest = sorted(self._added, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        if self._cut is None or not self._cut.search(text):
            return self._words.encode(text)
        parts = self._cut.split(text)  # every second part is an added token
        return b"".join(self._added[p] if i % 2 else self._words.encode(p) for i, p in enumerate(parts))


_ENCODERS: dict[str, TextEncoder] = {}


def _encoder(path: str) -> TextEncoder:
    """One encoder per worker process, so that later tasks find the words of earlier ones."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_column: str = "doc_id",
           text_column: str = "text", end_id: int = 0) -> DataFrame:
    """The pieces of every document, with their rank among the pieces of one length in one task.

    A document is its ids and then ``end_id``; null counts as empty. The ids are those of
    ``tokenizers`` with add_special_tokens=False, so a text may hold added tokens of the file. One longer than ``capacity``
    is cut so that all pieces but the first are full.
    """
    schema = arrow_schema(PIECES)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        encoder = _encoder(tokenizer_path)
        last = end_id.to_bytes(4, "little")

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            texts = texts_of(batch.column("text"))
            for doc_id, text in zip(batch.column("id").to_pylist(), texts):
                raw = encoder.encode(text) + last
                total = len(raw) // 4
                number, start = 0, 0
                while start < total:
                    length = (total - start - 1) % capacity + 1
                    crc = zlib.crc32(memoryview(raw)[4 * start:4 * (start + length)])
                    yield doc_id, number, start, length, crc, part, seen[length]
                    seen[length] += 1
                    number, start = number + 1, start + length

        for batch in source:
            yield from batches(schema, rows(batch))

    return docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(run, PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over counts: (length, first rank, slots, first sequence, offset).

    Sequences that hold the same lengths are one pattern with a number of copies, so the work and
    the plan depend on the number of lengths, not on the number of documents. Each length goes to
    the fullest patterns that still have room, and to new sequences when none has.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # free places: sequence ranges (first, copies)
    used = 0

    def put(left: int, first: int, copies: int) -> None:
        if left:
            room.setdefault(left, []).append((first, copies))

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            fits = min((left for left in room if left >= length), default=None)
            if fits is None:
                each = capacity // length
                opened = max(1, todo // each)
                filled = min(each, todo)
                for i in range(filled):
                    slots.append((length, rank, opened, used, i * length))
                    rank += opened
                todo -= filled * opened
                put(capacity - filled * length, used, opened)
                used += opened
                continue
            first, copies = room[fits].pop()
            if not room[fits]:
                del room[fits]
            taken = min(copies, todo)
            slots.append((length, rank, taken, first, capacity - fits))
            rank, todo = rank + taken, todo - taken
            put(fits - length, first, taken)
            if copies > taken:
                put(fits, first + taken, copies - taken)
    return slots


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_column: str = "doc_id",
         text_column: str = "text", end_id: int = 0, slot_run: int = 20_000) -> DataFrame:
    """Places every piece of every document in a sequence of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset; sequences are gapless
    from offset 0. Only the histogram of lengths (at most ``capacity`` rows) comes to the driver. The plan
    gives runs of slots for each length, Spark turns runs into one row per slot, and pieces take
    the slots by joining on length and rank within the length, a unique key on both sides. Ranks
    are the count of the tasks before plus the rank within the task, so no length, however
    frequent, is gathered anywhere; pieces are first written to the shared folder, so that ranks
    stay the same when a task runs again. Null or empty texts are one piece of length 1; repeated
    rows are packed each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    held = written(pieces(docs, tokenizer_path, capacity, id_column, text_column, end_id), "pieces")
    by_part = held.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = by_part.select("length", "part", F.expr(
        "sum(n) over (partition by length order by part) - n").alias("before"))
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = [(length, rank + at, min(slot_run, copies - at), sequence + at, offset)
            for length, rank, copies, sequence, offset in plan(counts, capacity)
            for at in range(0, copies, slot_run)]
    planned = spark.createDataFrame(
        runs, "length bigint, first bigint, n bigint, seq bigint, offset bigint")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = (planned.repartition(parts, "length", "first")
             .select("length", "first", "seq", "offset", F.explode(F.sequence(
                 F.lit(0).cast("bigint"), F.col("n") - 1)).alias("i"))
             .select("length", (F.col("first") + F.col("i")).alias("slot"),
                     (F.col("seq") + F.col("i")).alias("sequence_id"), "offset"))
    ranked = held.join(before, ["length", "part"]).withColumn("slot", F.col("before") + F.col("rank"))
    return ranked.join(slots, ["length", "slot"]).select(
        F.col("doc_id").alias(id_column), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
