"""Toxic spans: a linear-chain conditional random field over the words of every sentence."""

from __future__ import annotations

import heapq
import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_schema, bounded_sample, texts_of, written
from rivulet.llm.quality import calibrate

WORD = re.compile(r"[^\W\d_]+")
#: Words, and the stops that end a sentence.
TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
#: A sequence of the field is a run of words without a stop between them, of at most so many words;
#: longer runs go on in a new sequence.
SEQUENCE = 64
DIMENSIONS = 1 << 18  # a power of two
#: Word beginnings that are features besides the word itself.
PREFIXES = (4, 5, 6, 7, 8)
#: A feature marks toxic words when it occurs in so many toxic sample documents and is so much
#: likelier there (natural logarithm of the ratio) than in the others.
LEAST_DOCUMENTS = 4
LEAST_RATIO = 2.0
KEPT_WORDS = 600_000


def features_of(word: str) -> list[str]:
    """The word, and its beginnings."""
    return ["=" + word, *[word[:n] for n in PREFIXES if len(word) > n]]


def slot(feature: str) -> int:
    return zlib.crc32(feature.encode()) & (DIMENSIONS - 1)


def starts_of(stops: np.ndarray) -> np.ndarray:
    """Sizes of the sequences of a document, given which of its tokens are stops."""
    runs = np.diff(np.flatnonzero(np.concatenate([[True], stops, [True]]))) - 1
    runs = runs[runs > 0]
    whole, rest = runs // SEQUENCE, runs % SEQUENCE
    parts = whole + (rest > 0)
    sizes = np.full(int(parts.sum()), SEQUENCE, dtype=np.int64)
    ends = np.cumsum(parts) - 1
    sizes[ends] = np.where(rest > 0, rest, SEQUENCE)
    return sizes


def sequences(text: str) -> list[list[str]]:
    """Lower-cased words of a text in sequences of bounded length; every word is in one."""
    tokens = TOKEN.findall(text.lower())
    words = [t for t in tokens if t not in ".!?\n"]
    out, at = [], 0
    for size in starts_of(np.array([t in ".!?\n" for t in tokens], dtype=bool)).tolist():
        out.append(words[at:at + size])
        at += size
    return out


class WordScores(dict):
    """How much the features of a word favour toxic over clean; stops have no number."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        super().__init__((stop, np.nan) for stop in ".!?\n")
        self.weights, self.bias = weights.tolist(), bias

    def __missing__(self, word: str) -> float:
        weights, found = self.weights, self.bias
        for feature in features_of(word):
            found += weights[slot(feature)]
        if len(self) < KEPT_WORDS:
            self[word] = found
        return found


class ToxicField:
    """State scores of features, transitions between clean (0) and toxic (1), and the calibration."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray, bias: float,
                 calibration: np.ndarray | None = None) -> None:
        self.weights, self.transitions, self.bias = weights, transitions, bias
        self.calibration = calibration
        self._known: WordScores | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_known": None}

    @property
    def known(self) -> WordScores:
        if self._known is None:
            self._known = WordScores(self.weights, self.bias)
        return self._known

    def tagged(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all words of a text in a row, and the sizes of its sequences."""
        tokens = TOKEN.findall(text.lower())
        scores = np.fromiter(map(self.known.__getitem__, tokens), dtype=np.float64, count=len(tokens))
        stops = np.isnan(scores)
        return scores[~stops], starts_of(stops)

    def marginals(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Probability of toxic for every word; ``scores`` has the words of all sequences in a row.

        Forward and backward passes over the odds of toxic, for all sequences of a batch at once.
        """
        x, inside = _padded(scores, sizes)
        n, width = x.shape
        (t00, t01), (t10, t11) = np.exp(self.transitions)
        e = np.ascontiguousarray(np.exp(np.clip(x, -30, 30)).T)
        odds = np.empty((width, n))
        odds[0] = e[0]
        for i in range(1, width):
            odds[i] = e[i] * (t01 + odds[i - 1] * t11) / (t00 + odds[i - 1] * t10)
        later = np.ones(n)
        within = np.ascontiguousarray(inside.T)
        for i in range(width - 1, 0, -1):
            odds[i] *= later
            weight = e[i] * later
            later = np.where(within[i], (t10 + t11 * weight) / (t00 + t01 * weight), 1.0)
        odds[0] *= later
        return (odds / (1 + odds)).T[inside]

    def document(self, probabilities: np.ndarray) -> list[float]:
        """What the calibration sees: expected toxic words and their share, the surest word."""
        if not len(probabilities):
            return [0.0, 0.0, 0.0, 0.0]
        total = float(probabilities.sum())
        second = float(np.partition(probabilities, -2)[-2]) if len(probabilities) > 1 else 0.0
        return [float(np.log1p(total)), float(np.log1p(100 * total / len(probabilities))),
                float(probabilities.max()), second]

    def score(self, aggregates: np.ndarray) -> np.ndarray:
        if self.calibration is None:
            return np.zeros(len(aggregates))
        x = np.concatenate([np.ones((len(aggregates), 1)), aggregates], axis=1)
        return 1 / (1 + np.exp(-np.clip(x @ self.calibration, -30, 30)))


def _padded(scores: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = int(sizes.max(initial=1))
    inside = np.arange(width) < sizes[:, None]
    out = np.zeros((len(sizes), width))
    out[inside] = scores
    return out, inside


def forward_backward(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray,
                     ) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of the words, expected transitions (2 x 2) and the log partition of all sequences."""
    x, inside = _padded(scores, sizes)
    n, width = x.shape
    t = np.exp(transitions)
    e = np.exp(np.clip(x, -30, 30))
    alpha = np.zeros((width, n, 2))
    norm = np.ones((width, n))
    alpha[0] = np.stack([np.ones(n), e[:, 0]], axis=1)
    for i in range(width):
        if i:
            moved = alpha[i - 1] @ t
            moved[:, 1] *= e[:, i]
            alpha[i] = np.where(inside[:, i, None], moved, alpha[i - 1])
        norm[i] = np.where(inside[:, i], alpha[i].sum(axis=1), 1.0)
        alpha[i] /= np.where(inside[:, i], norm[i], alpha[i].sum(axis=1))[:, None]
    beta = np.ones((n, 2))
    marginal = np.zeros((n, width))
    expected = np.zeros((2, 2))
    for i in range(width - 1, -1, -1):
        both = alpha[i] * beta
        marginal[:, i] = both[:, 1] / both.sum(axis=1)
        if i:
            right = beta * np.stack([np.ones(n), e[:, i]], axis=1)
            pair = alpha[i - 1][:, :, None] * t[None] * right[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            expected += pair[inside[:, i]].sum(axis=0)
            back = right @ t.T
            back /= back.sum(axis=1, keepdims=True)
            beta = np.where(inside[:, i, None], back, beta)
    return marginal[inside], expected, float(np.log(norm).sum())


def train_field(tokens: list[list[str]], labels: list[list[int]], rounds: int = 40, rate: float = 0.5,
                penalty: float = 1e-4) -> ToxicField:
    """Maximum likelihood with a ridge penalty by full gradients with per-coordinate (AdaGrad) rates."""
    sizes = np.array([len(s) for s in tokens], dtype=np.int64)
    words = [w for s in tokens for w in s]
    y = np.array([v for s in labels for v in s], dtype=np.float64)
    types = {w: i for i, w in enumerate(dict.fromkeys(words))}
    kind = np.array([types[w] for w in words])
    pairs = [(i, slot(f)) for w, i in types.items() for f in features_of(w)]
    rows, slots = (np.array(c) for c in zip(*pairs))
    used, local = np.unique(slots, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    observed = np.zeros((2, 2))
    later = np.setdiff1d(np.arange(len(words)), starts)
    np.add.at(observed, (y[later - 1].astype(int), y[later].astype(int)), 1)
    w, bias, t = np.zeros(len(used)), 0.0, np.zeros((2, 2))
    gw, gb, gt = np.full(len(used), 1e-6), 1e-6, np.full((2, 2), 1e-6)
    order = np.argsort(sizes, kind="stable")
    chunks = np.array_split(order, max(1, len(order) // 4096))
    places = [np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in c]) for c in chunks]
    for _ in range(rounds):
        score = bias + np.bincount(rows, weights=w[local], minlength=len(types))
        p, expected = np.zeros(len(words)), np.zeros((2, 2))
        for chunk, place in zip(chunks, places):
            p[place], pair, _ = forward_backward(score[kind[place]], sizes[chunk], t)
            expected += pair
        off = np.bincount(kind, weights=p - y, minlength=len(types))
        d = np.bincount(local, weights=off[rows], minlength=len(used)) + penalty * len(sizes) * w
        gw += d * d
        w -= rate * 4 * d / np.sqrt(gw)
        db, dt = off.sum(), expected - observed
        gb += db * db
        bias -= rate * db / np.sqrt(gb)
        gt += dt * dt
        t -= rate * dt / np.sqrt(gt)
    weights = np.zeros(DIMENSIONS, dtype=np.float32)
    weights[used] = w
    return ToxicField(weights, t, bias)


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "label", sample_rows: int = 1500, features: int = 5000,
        plain_sequences: int = 2000) -> ToxicField:
    """Learns from at most about ``sample_rows`` labelled rows of each label (0, 1).

    Only documents are labelled, so words get their labels first: Spark counts in how many toxic and
    other sample documents each word and word beginning occurs, and words of toxic documents
    with a feature far likelier there are labelled toxic. The field is trained on the
    sequences around those words and as many others, in one task; document scores are then calibrated on
    the document labels, each weighing as in all labelled rows. The sample (documented bound) is taken by the hash of the id. Two more
    bounds on learning: the ``features`` strongest words and beginnings may mark words, and of the sample's sequences
    without such a word evenly spaced ones are taken, fewer than twice the larger of ``plain_sequences`` and
    double the number of the others.
    Rows with other or null labels are left out; without rows of both labels every score is 0.
    """
    sample = bounded_sample(labelled.where(F.col(label_column).isin(0, 1)), id_column, label_column,
                            text_column, sample_rows)
    # Read three times below; written, so that the documents are searched for it only once.
    sample = written(sample.select("h", F.col("label").cast("int").alias("y"), "text", "weight"),
                     "toxic-sample")
    candidates = _candidates(sample, features)

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [pickle.dumps(_learn(rows, candidates, plain_sequences))]})

    rows = sample.groupBy(F.lit(0).alias("one")).applyInPandas(learn, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else _empty()


def _empty() -> ToxicField:
    return ToxicField(np.zeros(DIMENSIONS, dtype=np.float32), np.zeros((2, 2)), -20.0)


def _candidates(sample: DataFrame, most: int) -> dict[str, float]:
    """Features likelier in toxic documents, with the ratio: the strongest, ``most`` at most."""
    schema = arrow_schema("feature string, y int")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            labels = batch.column("y").to_pylist()
            for y, text in zip(labels, texts_of(batch.column("text"))):
                found = sorted({f for w in set(WORD.findall(text.lower())) for f in features_of(w)})
                yield pa.record_batch([pa.array(found, pa.string()), pa.array([y] * len(found), pa.int32())],
                                      schema=schema)

    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return {}
    toxic, clean = F.col("toxic"), F.col("clean")
    ratio = F.log((toxic + 0.5) / (sizes[1] + 1)) - F.log((clean + 0.5) / (sizes[0] + 1))
    counted = (sample.select("y", "text").mapInArrow(run, "feature string, y int")
               .groupBy("feature").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean")))
    few = max(2, min(LEAST_DOCUMENTS, sizes[1] // 4))
    strong = counted.where((toxic >= few) & (ratio >= min(LEAST_RATIO, float(np.log(sizes[0] + 1)))))
    best = strong.orderBy((ratio * F.sqrt(toxic)).desc(), "feature").limit(most)
    return {r["feature"]: r["ratio"] for r in best.select("feature", ratio.alias("ratio")).collect()}


def explaining(candidates: dict[str, float], documents: list[set[str]], least: float) -> set[str]:
    """Features that explain the toxic documents one after the other.

    Always the feature is taken that is strongest over the documents not explained yet; a document
    counts less with each feature found in it. So words that toxic documents share only because they are
    copies of each other are not needed once the truly toxic words are taken.
    """
    holders: dict[str, list[int]] = {}
    for i, found in enumerate(documents):
        for f in found:
            holders.setdefault(f, []).append(i)
    lists = {f: np.array(i) for f, i in holders.items()}
    open_share, hits, chosen = np.ones(len(documents)), np.zeros(len(documents)), set()
    heap = [(-candidates[f] * np.sqrt(len(i)), f) for f, i in lists.items()]
    heapq.heapify(heap)
    while heap:
        _, f = heapq.heappop(heap)
        left = open_share[lists[f]].sum()
        now = -candidates[f] * np.sqrt(left)
        if left < least:
            continue
        if heap and now > heap[0][0]:
            heapq.heappush(heap, (now, f))
            continue
        chosen.add(f)
        hits[lists[f]] += 1
        open_share = 1 / (1 + hits)
    return chosen


def _learn(rows: pd.DataFrame, candidates: dict[str, float], plain_sequences: int) -> ToxicField:
    rows = rows.sort_values(["h", "y"], kind="stable").reset_index(drop=True)
    y = rows["y"].to_numpy()
    if len(np.unique(y)) < 2:
        return _empty()
    documents = [sequences(t) for t in rows["text"]]
    toxic = [{f for s in d for w in set(s) for f in features_of(w) if f in candidates}
             for d, label in zip(documents, y) if label]
    lexicon = explaining(candidates, toxic, min(LEAST_DOCUMENTS, len(toxic) / 8) * 0.6)
    fitted = np.arange(len(y)) % 4 != 3 if len(y) >= 40 else np.ones(len(y), dtype=bool)
    tokens, labels, plain, marked = [], [], [], {}
    for i in np.flatnonzero(fitted):
        for words in documents[i]:
            marks = [marked[w] if w in marked else marked.setdefault(
                w, int(any(f in lexicon for f in features_of(w)))) for w in words]
            if any(marks):
                tokens.append(words)
                labels.append(marks if y[i] else [0] * len(words))
            else:
                plain.append(words)
    step = max(1, len(plain) // max(1, plain_sequences, 2 * len(tokens)))
    tokens += plain[::step]
    labels += [[0] * len(w) for w in plain[::step]]
    if not any(map(any, labels)):
        return _empty()
    field = train_field(tokens, labels)
    rest = np.flatnonzero(~fitted) if not fitted.all() else np.arange(len(y))
    x = np.array([field.document(field.marginals(*tagged) if len((tagged := field.tagged(t))[0])
                                 else np.zeros(0)) for t in rows["text"][rest]])
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    field.calibration = calibrate(x, y[rest].astype(float), penalty=0.05,
                                  weights=rows["weight"].to_numpy()[rest])
    return field


def score(docs: DataFrame, field: ToxicField, id_column: str = "doc_id", text_column: str = "text",
          least: float = 0.5) -> DataFrame:
    """id, score (0 to 1) and spans (offending places as ``start:end``, comma-joined) of every row.

    A span is a word whose marginal probability of toxic is at least ``least``; code points from 0,
    end exclusive. Null texts are scored as empty; texts without words have no toxic word.
    """
    schema = arrow_schema("id bigint, score double, spans string")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids, at, held, size = batch.column("id"), 0, [], 0
            for i, text in enumerate(texts_of(batch.column("text"))):
                held.append(text)
                size += len(text)
                if size >= 4 << 20 or i + 1 == batch.num_rows:
                    found, spans = _score_texts(field, held, least)
                    yield pa.record_batch([ids.slice(at, len(held)), pa.array(found, pa.float64()),
                                           pa.array(spans, pa.string())], schema=schema)
                    at, held, size = i + 1, [], 0

    ddl = "id bigint, score double, spans string"
    return docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(run, ddl).withColumnRenamed("id", id_column)


def _score_texts(field: ToxicField, texts: list[str], least: float) -> tuple[np.ndarray, list[str]]:
    tagged = [field.tagged(t) for t in texts]
    scores, sizes = np.concatenate([s for s, _ in tagged]), np.concatenate([n for _, n in tagged])
    starts = np.cumsum(sizes) - sizes
    p = np.zeros(len(scores))
    order = np.argsort(sizes, kind="stable")  # sequences of like length are taken together
    for chunk in np.array_split(order, max(1, len(order) // 2048)):
        if len(chunk):
            place = np.repeat(starts[chunk] - np.cumsum(sizes[chunk]) + sizes[chunk], sizes[chunk])
            place += np.arange(len(place))
            p[place] = field.marginals(scores[place], sizes[chunk])
    aggregates, spans, at = [], [], 0
    for text, (own, _) in zip(texts, tagged):
        found = p[at:at + len(own)]
        at += len(own)
        aggregates.append(field.document(found))
        hot = set(np.flatnonzero(found >= least).tolist())
        spans.append(_places(text, hot) if hot else "")
    return field.score(np.array(aggregates)), spans


def _places(text: str, hot: set[int]) -> str:
    """Offsets of some words of the text, counted as ``sequences`` counts them."""
    lowered = text.lower()
    if len(lowered) != len(text):  # a character whose lower case is longer: map back one by one
        origin = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
    else:
        origin = None
    out = []
    for i, found in enumerate(WORD.finditer(lowered)):
        if i in hot:
            start, end = found.span()
            out.append(f"{origin[start]}:{origin[end]}" if origin else f"{start}:{end}")
    return ",".join(out)
