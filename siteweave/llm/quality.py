"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer numpy network with calibrated output.

Every term (a word, or the shape of a word outside the vocabulary) has a sparse random index vector that its name alone
determines; its word vector is the sum of the index vectors of its neighbours in the training texts, plus its own. A
document is the mean of its terms' vectors, their spread, and a few figures. A network of two layers turns that into a
logit; a temperature, fitted on rows that the network has not seen, turns the logit into a probability.

The driver trains on a bounded sample: at most ``SAMPLE_ROWS`` labelled rows, those whose ids have the smallest hashes, and
at most ``VOCABULARY`` words. Scoring reads every text whole. Labels, language, source and id are never inputs of a score.

Defined results: null and empty texts are documents without terms and get the score of such; without labels of both classes
every score is the share of good labels (1 without any label); repeated rows get equal scores; null ids are never labelled;
an empty table gives an empty table; ``score`` puts ``__score`` in the place of a column that is called so.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that are learned from, words that get a vector of their own, and how often such a word occurs at least.
SAMPLE_ROWS, VOCABULARY, LEAST_COUNT = 6000, 20_000, 5
#: Length of the vectors, non-zero entries of an index vector, neighbours to each side, and hidden units.
DIMENSIONS, NON_ZERO, NEIGHBOURS, HIDDEN = 64, 6, 2, 32
#: Every fifth of the rows calibrates; the others train.
CALIBRATION = 5

_RUN = re.compile(r"(.)\1+")
_SHAPE = {**dict.fromkeys(map(ord, "abcdefghijklmnopqrstuvwxyz"), "a"), **dict.fromkeys(map(ord, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "A"), **dict.fromkeys(map(ord, "0123456789"), "9")}


def shape(word: str) -> str:
    """Letters and digits as their kinds, runs as two, so that all plain words are alike; never a word itself."""
    kinds = word.translate(_SHAPE)
    if not kinds.isascii():
        kinds = "".join(c if c.isascii() else "A" if c.isupper() else "a" if c.isalpha() else c for c in kinds)
    return "\x01" + _RUN.sub(r"\1\1", kinds)


def index_vector(term: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    draw = np.random.default_rng(zlib.crc32(term.encode()))
    out = np.zeros(dimensions, np.float32)
    out[draw.choice(dimensions, NON_ZERO, replace=False)] = draw.choice([-1.0, 1.0], NON_ZERO)
    return out


class Model:
    """Word vectors, network and temperature; small enough to travel with a task."""

    def __init__(self) -> None:
        self.vectors: dict[str, int] = {}
        self.matrix = np.zeros((1, DIMENSIONS), np.float32)
        self.constant: float | None = 1.0
        self._shapes: dict[str, int] = {}

    def _row(self, word: str) -> int:
        """Row of a word's vector: its own, its shape's, or that of unknown shapes (0)."""
        found = self.vectors.get(word)
        if found is None:
            found = self._shapes.get(word)
            if found is None:
                if len(self._shapes) > 200_000:
                    self._shapes.clear()
                found = self._shapes[word] = self.vectors.get(shape(word), 0)
        return found

    def learn_vectors(self, texts: list[str]) -> None:
        counts = Counter(w for t in texts for w in t.split())
        words = [w for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if n >= LEAST_COUNT][:VOCABULARY]
        shapes = sorted({shape(w) for w in counts})
        self.vectors = {term: k + 1 for k, term in enumerate([*words, *shapes])}
        index = np.vstack([np.zeros((1, DIMENSIONS), np.float32), *[index_vector(t) for t in self.vectors]])
        summed = index.copy()
        for text in texts:
            rows = np.fromiter(map(self._row, text.split()), np.int64)
            for k in range(1, NEIGHBOURS + 1):
                if len(rows) > k:
                    np.add.at(summed, rows[k:], index[rows[:-k]])
                    np.add.at(summed, rows[:-k], index[rows[k:]])
        norms = np.linalg.norm(summed, axis=1, keepdims=True)
        self.matrix = summed / np.where(norms > 0, norms, 1)

    def features(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        n = len(words)
        out = np.zeros(2 * DIMENSIONS + 8, np.float32)
        if not n:
            return out
        counts = Counter(words)
        rows = np.fromiter(map(self._row, counts), np.int64, len(counts))
        weights = np.fromiter(counts.values(), np.float32, len(counts)) / n
        vectors = self.matrix[rows]
        mean = weights @ vectors
        out[:DIMENSIONS] = mean
        out[DIMENSIONS : 2 * DIMENSIONS] = np.sqrt(np.maximum(weights @ (vectors * vectors) - mean * mean, 0))
        letters = max(1, sum(map(len, words)))
        pairs = len(set(zip(words, words[1:], strict=False)))
        plain = sum(c.isalpha() for c in text)
        out[2 * DIMENSIONS :] = [
            1.0, np.log1p(n) / 8, letters / n / 16, len(counts) / n, pairs / max(1, n - 1), float(weights.max()), plain / letters, sum(map(str.isupper, text)) / letters,
        ]
        return out

    def train(self, rows: np.ndarray, labels: np.ndarray, seed: int = 3) -> None:
        """Adam over whole mini-batches, classes weighted to be equal in training; the temperature and an offset undo that."""
        if len(labels) < CALIBRATION or not 0 < labels.mean() < 1:
            self.constant = float(labels.mean()) if len(labels) else 1.0
            return
        self.constant = None
        self.center, self.scale = rows.mean(0), rows.std(0) + 1e-3
        x = (rows - self.center) / self.scale
        held = np.arange(len(x)) % CALIBRATION == 0
        draw = np.random.default_rng(seed)
        own, target = x[~held], labels[~held].astype(np.float32)
        weight = np.where(target > 0, 0.5 / max(target.mean(), 1e-6), 0.5 / max(1 - target.mean(), 1e-6))
        p = {"w1": draw.normal(0, np.sqrt(1 / own.shape[1]), (own.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": draw.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), "b2": np.zeros(1)}
        m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
        for _ in range(40):
            for part in np.array_split(draw.permutation(len(own)), max(1, len(own) // 128)):
                h = np.tanh(own[part] @ p["w1"] + p["b1"])
                out = 1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30)))
                d = (out - target[part]) * weight[part] / len(part)
                back = np.outer(d, p["w2"]) * (1 - h * h)
                grad = {"w1": own[part].T @ back + 2e-4 * p["w1"], "b1": back.sum(0), "w2": h.T @ d + 2e-4 * p["w2"], "b2": np.array([d.sum()])}
                step += 1
                for k in p:
                    m[k] = 0.9 * m[k] + 0.1 * grad[k]
                    v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                    p[k] -= 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.p = p
        self.offset, self.temperature = self._calibrate(self._logits(x[held]), labels[held])

    @staticmethod
    def _calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
        """The pair of least log loss on a grid: offset first added, then the temperature divides."""
        best = (np.inf, 0.0, 1.0)
        if not 0 < labels.mean() < 1:
            return 0.0, 1.0
        for temperature in np.geomspace(0.25, 16, 37):
            for offset in np.linspace(-6, 6, 49):
                z = np.clip((logits + offset) / temperature, -30, 30)
                loss = float(np.mean(np.log1p(np.exp(-z)) * labels + np.log1p(np.exp(z)) * (1 - labels)))
                if loss < best[0] - 1e-9:
                    best = (loss, float(offset), float(temperature))
        return best[1], best[2]

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p["w1"] + self.p["b1"]) @ self.p["w2"] + self.p["b2"]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        z = (self._logits((rows - self.center) / self.scale) + self.offset) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from: crc32 of the id as text, divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, label: str = "quality") -> Model:
    """A model from at most ``rows`` labelled rows outside the held-out fold; their texts come to the driver."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.min(label).alias("__label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")  # ``own`` is bounded by ``rows``
    # ids may repeat: of their rows, too, only the first ``rows`` come to the driver
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(rows).toPandas()
    sample = sample.sort_values(["doc_id", "text"], na_position="first").sample(frac=1, random_state=11)
    model = Model()
    if len(sample):
        model.learn_vectors([t or "" for t in sample["text"]])
        model.train(np.vstack([model.features(t) for t in sample["text"]]), sample["__label"].to_numpy())
        model._shapes = {}
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``__score``, the probability that each text is labelled 1. The model, of bounded size, is broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = sent.value
        for texts in batches:
            yield pd.Series(own.scores(np.vstack([own.features(t) for t in texts])) if len(texts) else [], index=texts.index, dtype="float64")

    return docs.withColumn("__score", scored(F.col("text")))
