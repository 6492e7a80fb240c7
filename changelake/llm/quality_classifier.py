"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

A text becomes a sparse vector over a fixed number of hashed slots: words, pairs of
neighbouring words, word shapes (runs of letters or digits shrunk to one sign, all
other signs kept) and pairs of shapes with a mark for equal neighbours.  Each group
counts relative to its size, so that long texts weigh as much as short ones.

Fitting reads at most ``TRAIN_ROWS`` labelled rows, those with the smallest hashed
ids; the feature vectors are made where the rows lie, and one task runs the updates
over them as a stream.  Scoring covers every row of every text.

Defined results: a null or empty text has no features and scores as the bias alone;
rows without a label or an id never train; with no training row every score is 0.5.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from changelake.llm.shipping import ship
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 20  # the weights' size, whatever the input's
TRAIN_ROWS = 8_000
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-3
SCALE = 4.0
CACHED_WORDS = 300_000
ROWS_AT_ONCE = 500
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _hash(text: bytes) -> int:
    return zlib.crc32(text) | zlib.crc32(text, 0x5BD1E995) << 32


def _shape(word: str) -> str:
    def letters(m: re.Match) -> str:
        run = m.group()
        return "A" if run.isupper() and len(run) > 1 else "a"

    return _DIGITS.sub("0", _LETTERS.sub(letters, word))


class Features:
    """Sparse vectors of texts; remembers a bounded number of words."""

    def __init__(self) -> None:
        self.words: dict[str, tuple[int, int]] = {}

    def _known(self, words: list[str]) -> None:
        missing = {w for w in set(words) if w not in self.words}
        if len(self.words) + len(missing) > CACHED_WORDS:
            self.words.clear()
            missing = set(words)
        for w in missing:
            self.words[w] = (_hash(w.lower().encode()), _hash(b"\1" + _shape(w).encode()))

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct slots and their values."""
        words = text.split()
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        slots, values = self.raw(words)
        distinct, where = np.unique(slots, return_inverse=True)
        return distinct.astype(np.int32), np.bincount(where, weights=values).astype(np.float32)

    def raw(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Slots with repeats, and the value of each occurrence."""
        self._known(words)
        both = np.array([self.words[w] for w in words], dtype=np.uint64)
        word, shape = both[:, 0], both[:, 1]
        same = (word[1:] == word[:-1]).astype(np.uint64)
        groups = [word, word[:-1] * _PAIR + word[1:], shape, (shape[:-1] * _PAIR + shape[1:]) * _MIX + same]
        with np.errstate(over="ignore"):
            slots = np.concatenate([(g * _MIX) >> np.uint64(44) for g in groups]).astype(np.int64)
        n = len(words)
        values = np.repeat([SCALE / n, SCALE / max(1, n - 1)] * 2, [n, n - 1, n, n - 1])
        return slots, values


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


class Ftrl:
    """Follow-the-regularised-leader state over the slots; the last entry is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros(SLOTS + 1)
        self.n = np.zeros(SLOTS + 1)

    def weights(self, slots: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        out = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        out[np.abs(z) <= L1] = 0
        return out

    def update(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        slots, values = np.append(slots, SLOTS), np.append(values, 1.0)
        w = self.weights(slots)
        g = (_sigmoid(float(w @ values)) - label) * values
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[slots] = n + g * g


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights of all slots and the bias, from at most ``rows`` labelled documents.

    ``docs`` and ``labels`` hold training rows only.  The driver gets at most
    ``SLOTS + 1`` numbers.
    """
    chosen = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key)
        .agg(F.max(label).cast("int").alias("__label"))
        .orderBy(F.xxhash64(key), key)
        .limit(rows)
    )
    sample = docs.select(key, F.col(text).alias("__text")).join(F.broadcast(chosen), key)
    order = F.xxhash64(F.col(key))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features.vector(t or "") for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), batch.column(2), pa.array([s for s, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, ["order", "label", "slots", "values"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = Ftrl(), False
        for batch in batches:
            for slots, values, y in zip(batch.column(2), batch.column(3), batch.column(1).to_pylist()):
                seen = True
                state.update(slots.values.to_numpy(), values.values.to_numpy().astype(float), y)
        w = state.weights(slice(None)) if seen else np.zeros(SLOTS + 1)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["slot", "weight"])

    ship(docs.sparkSession)
    made = sample.select(order.alias("order"), "__text", "__label").mapInArrow(vectors, "order long, label int, slots array<int>, values array<float>")
    found = made.repartition(1).sortWithinPartitions("order").mapInArrow(train, "slot long, weight double").toArrow()
    out = np.zeros(SLOTS + 1)
    out[found["slot"].to_numpy()] = found["weight"].to_numpy()
    return out


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` without its text, with the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    kept = [n for n in docs.columns if n not in (text, name)]
    schema = docs.select(*kept, F.lit(0.0).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, w = Features(), shared.value
        bias = float(w[SLOTS])
        for batch in batches:
            out = []
            for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
                words = (t or "").split()
                if words:
                    slots, values = features.raw(words)
                    out.append(_sigmoid(bias + float(w[slots] @ values)))
                else:
                    out.append(_sigmoid(bias))
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [pa.array(out, pa.float64())], [*kept, name])

    ship(docs.sparkSession)
    return docs.mapInArrow(run, schema)
