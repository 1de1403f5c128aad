"""Quality classifier: how much better a text compresses with good than with bad examples."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_schema, bounded_sample, texts_of

#: Bytes that are compressed by themselves, so that the dictionary counts all along a long text.
CHUNK_BYTES = 1024
DICTIONARY_BYTES = 32 << 10
LEVEL = 1


class CompressionModel:
    """Two dictionaries and the calibration of their compressed sizes."""

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray | None = None) -> None:
        self.good, self.bad, self.weights = good, bad, weights
        self._tools: tuple | None = None

    def __getstate__(self) -> dict:
        return {"good": self.good, "bad": self.bad, "weights": self.weights, "_tools": None}

    def _compressors(self) -> tuple:
        if self._tools is None:
            def tool(raw: bytes):
                held = zstandard.ZstdCompressionDict(raw) if raw else None
                if held is not None:
                    held.precompute_compress(level=LEVEL)
                return zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False,
                    write_checksum=False).compress
            self._tools = tool(self.good), tool(self.bad)
        return self._tools

    def features(self, text: str) -> list[float]:
        """Size difference and size ratio, over the whole text and at its worst chunk."""
        good, bad = self._compressors()
        raw = text.encode("utf-8", "surrogatepass")
        sum_good = sum_bad = 0
        worst, least = -1.0, 2.0
        for at in range(0, max(len(raw), 1), CHUNK_BYTES):
            chunk = raw[at:at + CHUNK_BYTES]
            g, b = len(good(chunk)), len(bad(chunk))
            sum_good += g
            sum_bad += b
            if len(chunk) >= CHUNK_BYTES // 4 or not at:
                worst = max(worst, (g - b) / max(g, b))
                least = min(least, min(g, b) / max(1, len(chunk)))
        most = max(sum_good, sum_bad, 1)
        return [(sum_good - sum_bad) / most, min(sum_good, sum_bad) / max(1, len(raw)), worst,
                min(least, 2.0)]

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1; 0.5 where nothing has been learned."""
        if self.weights is None:
            return np.full(len(features), 0.5)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-_expanded(features) @ self.weights))


def _expanded(features: np.ndarray) -> np.ndarray:
    """Calibration inputs: hinges along the difference and the ratio, over the text and its worst chunk."""
    x = np.asarray(features, dtype=np.float64).reshape(-1, 4)
    diff, ratio, worst, least = x.T
    columns = [np.ones(len(x))]
    for value, knots in ((diff, (-0.2, -0.1, -0.05, 0.0, 0.05, 0.1)), (worst, (-0.1, 0.0, 0.1)),
                         (ratio, (0.1, 0.2, 0.3, 0.4, 0.6)), (least, (0.1, 0.2, 0.3, 0.4))):
        columns.append(np.clip(value, -1, 2))
        columns += [np.maximum(value - knot, 0) for knot in knots]
    columns.append(diff * ratio)
    return np.stack(columns, axis=1)


def calibrate(x: np.ndarray, y: np.ndarray, penalty: float = 0.02, rounds: int = 60,
              weights: np.ndarray | None = None) -> np.ndarray:
    """Ridge logistic regression by damped Newton steps; classes weigh as they occur.

    ``weights`` are the rows of the table that each row stands for; the penalty is for one sample row.
    """
    w = np.zeros(x.shape[1])
    share = np.ones(len(y)) if weights is None else weights / weights.mean()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + penalty * w
        hessian = (x * (share * p * (1 - p) + 1e-9)[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _chunks_in_turn(texts: list[bytes], most: int) -> list[bytes]:
    """Chunks of up to ``most`` bytes in all: the first of every text, then the second of every text, and so on.

    So a very long text takes the place of no other text's beginning.
    """
    chunks, held, at, left = [], 0, 0, [t for t in texts if t]
    while left:
        for text in left:
            if held >= most:
                return chunks
            chunks.append(text[at:at + min(CHUNK_BYTES, most - held)])
            held += len(chunks[-1])
        at += CHUNK_BYTES
        left = [t for t in left if len(t) > at]
    return chunks


def _dictionary(texts: list[bytes], most: int) -> bytes:
    """A dictionary trained on chunks of the texts; raw content where there are too few to train."""
    chunks = _chunks_in_turn(texts, most)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, chunks).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(chunks)[-DICTIONARY_BYTES:]


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "label", sample_rows: int = 2500,
        dictionary_text: int = 8 << 20) -> CompressionModel:
    """Learns from at most about ``sample_rows`` labelled rows of each label (0, 1).

    The sample (documented bound; by the hash of the id) goes to one task as compressed
    text. Half of it builds the dictionaries and the other half calibrates, so the calibration
    sees texts that are not in the dictionaries, each label weighing as in all labelled rows. A dictionary is built
    from at most ``dictionary_text`` bytes of its half (a second bound), some of each text before more of one. Null texts count as empty; rows with other labels or null ones are left out.
    Without rows of both labels the model scores every text 0.5.
    """
    sample = bounded_sample(labelled.where(F.col(label_column).isin(0, 1)), id_column, label_column,
                            text_column, sample_rows)
    packed = sample.select("h", F.col("label").cast("int").alias("y"), "text", "weight")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        return _learn(rows, dictionary_text)

    rows = packed.groupBy(F.lit(0).alias("one")).applyInPandas(learn, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else CompressionModel(b"", b"")


def _learn(rows: pd.DataFrame, dictionary_text: int) -> pd.DataFrame:
    rows = rows.sort_values(["h", "y"], kind="stable").reset_index(drop=True)
    texts, y = [t or "" for t in rows["text"]], rows["y"].to_numpy()
    if len(np.unique(y)) < 2:
        return pd.DataFrame({"model": [pickle.dumps(CompressionModel(b"", b""))]})
    built = np.arange(len(y)) % 2 == 0 if len(y) >= 20 else np.ones(len(y), dtype=bool)

    def raw(label: int) -> list[bytes]:
        return [texts[i].encode("utf-8", "surrogatepass") for i in np.flatnonzero(built & (y == label))]

    model = CompressionModel(_dictionary(raw(1), dictionary_text), _dictionary(raw(0), dictionary_text))
    rest = np.flatnonzero(~built if not built.all() else built)
    x = np.array([model.features(texts[i]) for i in rest])
    model.weights = calibrate(_expanded(x), y[rest].astype(float), weights=rows["weight"].to_numpy()[rest])
    return pd.DataFrame({"model": [pickle.dumps(model)]})


def score(docs: DataFrame, model: CompressionModel, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """Id and score (0 to 1) of every row of ``docs``; null texts are scored as empty ones."""
    schema = arrow_schema("id bigint, score double")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            x = [model.features(t) for t in texts_of(batch.column("text"))]
            found = model.scores(np.array(x).reshape(-1, 4))
            yield pa.record_batch([batch.column("id"), pa.array(found, pa.float64())], schema=schema)

    return docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(run, "id bigint, score double").withColumnRenamed("id", id_column)


def keep_good(docs: DataFrame, model: CompressionModel, threshold: float = 0.7,
              text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, all columns as they were."""
    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        x = [model.features(t) for t in texts_of(text)]
        return pa.array(model.scores(np.array(x).reshape(-1, 4)), pa.float64())

    return docs.where(scored(F.col(text_column)) >= threshold)
