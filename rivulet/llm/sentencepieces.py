"""SentencePiece encoding and decoding: a Viterbi search that takes equal-length words ahead together."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_schema, texts_of

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Words above this length are first cut where no piece can lie across two characters.
LONG_WORD = 48
#: Distinct words whose ids a worker keeps; rarer ones are searched again.
KEPT_WORDS = 800_000
#: Words searched together.
TOGETHER = 1 << 15
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class PieceModel:
    """Vocabulary of a SentencePiece file and the search for the best pieces of a word.

    For a unigram model the path with the highest sum of scores wins. For a BPE model (merge order as score)
    only paths are allowed whose neighbouring pieces BPE would leave apart, which is exactly
    one per word: the pieces that merging gives.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.path = path
        held = sentencepiece_model_pb2.ModelProto()
        held.ParseFromString(SentencePieceProcessor(model_file=path).serialized_model_proto())
        spec = held.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that leave characters and white space as they are")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.merges = held.trainer_spec.model_type == 2
        kinds = held.SentencePiece
        self.surface: list[bytes] = []
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.unknown = 0
        self.score = np.array([p.score for p in held.pieces], dtype=np.float64)
        for i, p in enumerate(held.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.surface.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.ids[p.piece] = i
                self.surface.append(p.piece.replace(SPACE, " ").encode())
            else:
                if p.type == kinds.UNKNOWN:
                    self.unknown = i
                self.surface.append(b"")
        self.fallback = held.trainer_spec.byte_fallback
        self.longest = max(map(len, self.ids))
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        if self.prefix != SPACE or any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("only models whose words begin with the space mark")
        names = list(self.ids)
        keys = np.array([self._hash(p) for p in names], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array([self.ids[p] for p in names])[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a hash")
        self.names = {i: p for p, i in self.ids.items()}
        self.seen = np.zeros(1 << 18, dtype=bool)
        self.seen[(keys >> np.uint64(46)).astype(np.int64)] = True
        self.powers = np.array([pow(_BASE, k, 1 << 64) for k in range(self.longest + 1)], dtype=np.uint64)
        self.apart: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _hash(text: str) -> int:
        value = 0
        for c in text:
            value = (value * _BASE + ord(c) + 1) & _MASK
        return value

    def merged(self, text: str) -> list[str]:
        """Pieces by merging the neighbours with the best score first, the leftmost of equal ones."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.score[found] > best):
                    best, at = self.score[found], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _stay_apart(self, pair: int) -> bool:
        found = self.apart.get(pair)
        if found is None:
            left, right = self.names[pair >> 32], self.names[pair & 0xFFFFFFFF]
            found = (left[-1] + right[0] not in self.pairs
                     or self.merged(left + right) == [left, right])
            if len(self.apart) < 1_000_000:
                self.apart[pair] = found
        return found

    def search(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of words of one length; all advance together."""
        n, length = len(words), len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        points = points.reshape(n, length).astype(np.uint64)
        prefix = np.zeros((length + 1, n), dtype=np.uint64)
        base, one, high = np.uint64(_BASE), np.uint64(1), np.uint64(46)
        for i in range(length):
            prefix[i + 1] = prefix[i] * base + points[:, i] + one
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        back = np.ones((length + 1, n), dtype=np.int32)
        last = np.full((length + 1, n), -1, dtype=np.int64)  # -1: none or an unknown character
        for i in range(1, length + 1):
            # A character that is no piece stands by itself, at a price above any other path.
            best[i] = best[i - 1] - 1e12
            unsettled = np.ones(n, dtype=bool)
            for k in range(min(i, self.longest), 0, -1):
                key = prefix[i] - prefix[i - k] * self.powers[k]
                hit = np.flatnonzero(self.seen[(key >> high).astype(np.int64)] & unsettled)
                if not len(hit):
                    continue
                at = np.minimum(np.searchsorted(self.keys, key[hit]), len(self.keys) - 1)
                exact = self.keys[at] == key[hit]
                hit, piece = hit[exact], self.key_ids[at[exact]]
                if self.merges:
                    left = last[i - k, hit]
                    fine = left < 0
                    inner = np.flatnonzero(~fine)
                    codes, place = np.unique((left[inner] << 32) | piece[inner], return_inverse=True)
                    apart = np.fromiter(map(self._stay_apart, codes.tolist()), bool, len(codes))
                    fine[inner] = apart[place]
                    hit, piece = hit[fine], piece[fine]
                    unsettled[hit] = False  # no other piece can end a merged prefix here
                value = best[i - k, hit] + self.score[piece]
                better = value > best[i, hit]
                hit, piece = hit[better], piece[better]
                best[i, hit], back[i, hit], last[i, hit] = value[better], k, piece
        return self._paths(words, back, last)

    def _paths(self, words: list[str], back: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Follows the backpointers of all words from their ends."""
        n = len(words)
        at, rows = np.full(n, len(words[0])), np.arange(n)
        row_parts, id_parts = [], []
        while len(rows):
            row_parts.append(rows)
            id_parts.append(last[at[rows], rows])
            at[rows] -= back[at[rows], rows]
            rows = rows[at[rows] > 0]
        row, ids = np.concatenate(row_parts[::-1]), np.concatenate(id_parts[::-1])
        order = np.argsort(row, kind="stable")
        row, ids = row[order], ids[order]
        ends = np.cumsum(np.bincount(row, minlength=n)).tolist()
        raw = ids.astype("<i4").tobytes()
        out = [raw[4 * a:4 * b] for a, b in zip([0, *ends], ends)]
        for i in np.unique(row[ids < 0]).tolist():
            out[i] = self._with_unknown(words[i], back[:, i], last[:, i])
        return out

    def _with_unknown(self, word: str, back: np.ndarray, last: np.ndarray) -> bytes:
        ids, i = [], len(word)
        while i:
            k = int(back[i])
            ids.extend([int(last[i])] if last[i] >= 0 else self._unknown(word[i - k:i])[::-1])
            i -= k
        return np.array(ids[::-1], dtype="<u4").tobytes()

    def _unknown(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.fallback else [self.unknown]

    def _parts(self, word: str) -> list[str]:
        """A long word, cut between characters that no piece holds side by side."""
        parts, start = [], 0
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in self.pairs:
                parts.append(word[start:i])
                start = i
        return parts + [word[start:]]

    def _encode_words(self, words: set[str]) -> dict[str, bytes]:
        long = {w: self._parts(w) for w in words if len(w) > LONG_WORD}
        by_length: dict[int, list[str]] = {}
        for part in words.difference(long).union(*long.values()):
            by_length.setdefault(len(part), []).append(part)
        found: dict[str, bytes] = {}
        for length, same in by_length.items():
            step = max(1, min(TOGETHER, (1 << 22) // (length + 1)))
            for at in range(0, len(same), step):
                some = same[at:at + step]
                found.update(zip(some, self.search(some)))
        found.update((w, b"".join([found[p] for p in parts])) for w, parts in long.items())
        return found

    def _cut(self, text: str) -> list[str]:
        """The words of a text, each without the space mark that opens it."""
        if not text:
            return []
        if text[0] != " " and "  " not in text and SPACE not in text:
            return text.split(" ")
        return [w[1:] for w in WORD.findall(self.prefix + text.replace(" ", SPACE))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; each word is searched once."""
        cut, known, missing = [self._cut(t) for t in texts], self.known, set()
        for words in cut:
            missing.update(words)
        missing.difference_update(known)
        if missing:
            found = self._encode_words({SPACE + w for w in missing})
            new = {w: found[SPACE + w] for w in missing}
            if len(known) >= KEPT_WORDS:
                return [b"".join([known[w] if w in known else new[w] for w in words]) for words in cut]
            known.update(new)
        return [b"".join([known[w] for w in words]) for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; bytes that are no UTF-8 become U+FFFD, ids out of range nothing."""
        surface = self.surface
        raw = b"".join([surface[i] for i in ids.tolist() if 0 <= i < len(surface)])
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_MODELS: dict[str, PieceModel] = {}


def model_at(path: str) -> PieceModel:
    """One model per process, so that later tasks find the words of earlier ones."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode(docs: DataFrame, model_path: str, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """id, ids (array of int), n_ids and ids_crc32 (little-endian 32-bit ids) of every row.

    Null and empty texts have no ids. The model file must be found under the same path on every
    executor; it is read, never trained. Other columns are ignored.
    """
    schema = arrow_schema("id bigint, ids array<int>, n_ids bigint, ids_crc32 bigint")

    def emit(ids: list, found: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(f) // 4 for f in found], dtype=np.int32)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(found), dtype="<i4"), type=pa.int32())
        return pa.record_batch([
            pa.array(ids, type=pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), values),
            pa.array(sizes.astype(np.int64)), pa.array([zlib.crc32(f) for f in found], pa.int64()),
        ], schema=schema)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(model_path)
        for batch in source:
            own, held, chars, at = batch.column("id").to_pylist(), [], 0, 0
            for i, text in enumerate(texts_of(batch.column("text"))):
                held.append(text)
                chars += len(text)
                if chars >= 4 << 20 or i + 1 == len(own):
                    yield emit(own[at:i + 1], model.encode(held))
                    held, chars, at = [], 0, i + 1

    ddl = "id bigint, ids array<int>, n_ids bigint, ids_crc32 bigint"
    return docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(run, ddl).withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, model_path: str, id_column: str = "doc_id", ids_column: str = "ids",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """id, text and the columns named in ``keep`` of every row; null ids give an empty text."""
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(model_path)
        for batch in source:
            ids = batch.column("ids")
            step = max(1, (8 << 20) // max(1, batch.nbytes // max(1, batch.num_rows)))
            for at in range(0, batch.num_rows, step):
                part = ids.slice(at, step)
                texts = [model.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else ""
                         for x in part]
                held = [c.slice(at, step) for c, n in zip(batch.columns, batch.schema.names) if n != "ids"]
                yield pa.record_batch(
                    [held[0], pa.array(texts, pa.string()), *held[1:]], names=["id", "text", *keep])

    source = encoded.select(F.col(id_column).cast("bigint").alias("id"),
                            F.col(ids_column).alias("ids"), *keep)
    kinds = dict(encoded.dtypes)
    ddl = ", ".join(["id bigint", "text string", *[f"{c} {kinds[c]}" for c in keep]])
    return source.mapInArrow(run, ddl).withColumnRenamed("id", id_column)
