"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_schema, bounded_sample, texts_of

DIMENSIONS = 1 << 15
ORDERS = (1, 2, 3)
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all character n-grams of the lower-cased text, and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    step = 1 << 16
    for at in range(0, len(points), step):
        own = points[at:at + step + max(ORDERS) - 1]  # n-grams that begin in this stretch
        value = np.zeros(len(own), dtype=np.uint32)
        for n in ORDERS:
            if len(own) < n:
                break
            value = (value[:len(own) - n + 1] ^ (own[n - 1:] + np.uint32(n))) * _FACTORS[n - 1]
            value ^= value >> np.uint32(15)
            total += np.bincount(value[:step] >> np.uint32(17), minlength=DIMENSIONS)
    index = np.flatnonzero(total)
    return index, total[index]


class LanguageModel:
    """Classes, document frequencies, weights and temperature."""

    def __init__(self, classes: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.classes, self.idf, self.weights, self.temperature = classes, idf, weights, temperature

    def vector(self, index: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """TF-IDF values (1 + log of the count, times idf) of length 1."""
        value = (1 + np.log(counts)) * self.idf[index]
        return value / (np.sqrt((value * value).sum()) or 1.0)

    def predict(self, text: str) -> tuple[str, float]:
        """Most likely class and its calibrated probability; ``und`` without any letter or class."""
        if not self.classes or not LETTER.search(text):
            return UNKNOWN, 0.0
        index, counts = ngram_counts(text)
        logits = self.vector(index, counts) @ self.weights[index] / self.temperature
        logits = np.exp(logits - logits.max())
        best = int(logits.argmax())
        return self.classes[best], float(logits[best] / logits.sum())


def document_frequencies(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """feature, n: in how many texts of the whole table each feature occurs; feature -1 counts texts.

    Each task sums its texts into one vector of fixed size before anything is exchanged.
    """
    schema = arrow_schema("feature int, n bigint")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, texts = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in source:
            for text in texts_of(batch.column("text")):
                found[ngram_counts(text)[0]] += 1
                texts += 1
        index = np.flatnonzero(found)
        yield pa.record_batch([np.append(index, -1).astype(np.int32), np.append(found[index], texts)],
                              schema=schema)

    return (docs.select(F.col(text_column).cast("string").alias("text"))
            .mapInArrow(run, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n")))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 3,
         alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 0.002) -> np.ndarray:
    """Follow the regularised leader with per-coordinate rates and elastic-net penalties."""
    z = np.zeros((DIMENSIONS, classes))
    n = np.zeros((DIMENSIONS, classes))

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1, 0)
        return -shrunk / ((beta + np.sqrt(ni)) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            index, x, y = rows[i]
            zi, ni = z[index], n[index]
            w = weights(zi, ni)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            g = np.outer(x, p)
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[index] += g - sigma * w
            n[index] += g * g
    return weights(z, n)


def best_temperature(logits: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The temperature with the least (weighted) log loss, by golden-section search on its logarithm."""
    def loss(t: float) -> float:
        scaled = logits / np.exp(t)
        top = scaled.max(axis=1, keepdims=True)
        return float(np.average(np.log(np.exp(scaled - top).sum(axis=1)) + top[:, 0]
                                - scaled[np.arange(len(y)), y], weights=weights))

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(50):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "lang", sample_rows: int = 800) -> LanguageModel:
    """Learns from ``docs``: document frequencies from all rows, weights from a bounded sample.

    The sample has at most about ``sample_rows`` rows of each label (documented bound; by the
    hash of the id). Its n-gram counts go to one task, which fits on four fifths and sets the
    temperature on the rest, each label weighing as in all rows. Rows without text or label are not learned from; without any row the
    model knows no class and answers ``und``.
    """
    learn = docs.where(F.col(text_column).isNotNull() & F.col(label_column).isNotNull())
    frequency = {r["feature"]: r["n"] for r in document_frequencies(learn, text_column).collect()}
    texts = frequency.pop(-1, 0)
    found = np.zeros(DIMENSIONS)
    if frequency:
        found[list(frequency)] = list(frequency.values())
    idf = np.log((1 + texts) / (1 + found)) + 1
    counts_ddl = "h bigint, label string, weight double, features binary, counts binary"
    schema = arrow_schema(counts_ddl)

    def counted(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            pairs = [ngram_counts(t) for t in texts_of(batch.column("text"))]
            yield pa.record_batch([
                batch.column("h"), batch.column("label").cast(pa.string()), batch.column("weight"),
                pa.array([i.astype("<u2").tobytes() for i, _ in pairs], pa.binary()),
                pa.array([c.astype("<u4").tobytes() for _, c in pairs], pa.binary())], schema=schema)

    def learn_all(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "label"], kind="stable")
        classes = sorted(set(rows["label"]))
        model = LanguageModel(classes, idf, np.zeros((DIMENSIONS, len(classes))), 1.0)
        data = []
        for features, counts, label in zip(rows["features"], rows["counts"], rows["label"]):
            index = np.frombuffer(features, dtype="<u2").astype(np.int64)
            data.append((index, model.vector(index, np.frombuffer(counts, dtype="<u4")),
                         classes.index(label)))
        rest = data[::5] if len(data) >= 20 else data
        model.weights = ftrl([d for i, d in enumerate(data) if i % 5] if len(data) >= 20 else data,
                             len(classes))
        logits = np.array([x @ model.weights[i] for i, x, _ in rest])
        weights = rows["weight"].to_numpy()
        model.temperature = best_temperature(logits, np.array([y for *_, y in rest]),
                                             weights[::5] if len(data) >= 20 else weights)
        model.idf, model.weights = idf.astype(np.float32), model.weights.astype(np.float32)
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    sample = bounded_sample(learn, id_column, label_column, text_column, sample_rows)
    rows = (sample
            .mapInArrow(counted, counts_ddl)
            .groupBy(F.lit(0).alias("one")).applyInPandas(learn_all, "model binary").collect())
    if not rows:
        return LanguageModel([], idf, np.zeros((DIMENSIONS, 0)), 1.0)
    return pickle.loads(rows[0]["model"])


def predict(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """id, lang_pred and score (calibrated probability) of every row.

    A text that is null, empty or without letters is ``und`` with score 0.
    """
    schema = arrow_schema("id bigint, lang_pred string, score double")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [model.predict(t) for t in texts_of(batch.column("text"))]
            yield pa.record_batch([batch.column("id"), pa.array([f[0] for f in found], pa.string()),
                                   pa.array([f[1] for f in found], pa.float64())], schema=schema)

    return docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(run, "id bigint, lang_pred string, score double").withColumnRenamed("id", id_column)
