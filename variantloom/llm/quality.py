"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

A word is a run of letters, digits and bytes beyond ASCII, or a run of marks. Features are words, pairs of neighbours,
one for any word that follows itself and one for any that comes again after one other, hashed into 2 ** bits slots; a text's vector has length one. Only the text is an
input. The model is fitted on a bounded sample of labelled rows; every row is scored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BITS = 18
SAMPLE = 4000
EPOCHS = 3
FOLDS, TEST_FOLD = 3, 1
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.1
SAME, AGAIN = C.U64(0x5A3E), C.U64(0xA6A1)
RARE = 2.0
KIND = np.full(256, 2, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = 0
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of each text's vector, and where each text's begin (and the end)."""
    data, rows = C.utf8(texts)
    kind = KIND[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[rows] = True
    edges = np.flatnonzero(cut)
    solid = kind[edges[:-1]] > 0
    starts, lengths = edges[:-1][solid], np.diff(edges)[solid]
    word = C.hash_slices(C.LOWER[data], starts, lengths)
    row = np.searchsorted(rows, starts, "right") - 1
    pair = np.where(word[1:] == word[:-1], SAME, C.chain(word[:-1], word[1:]))
    near = row[1:] == row[:-1]
    again = np.flatnonzero((word[2:] == word[:-2]) & (row[2:] == row[:-2])) + 2
    slot = (np.concatenate([C.mix(word), C.mix(pair[near] + C.U64(1)), np.full(len(again), C.mix(np.array([AGAIN]))[0])]) >> C.U64(64 - bits)).astype(np.int64)
    key, n = C.distinct((np.concatenate([row, row[1:][near], row[again]]) << bits) | slot, counts=True)
    row, slot, value = key >> bits, key & ((1 << bits) - 1), np.sqrt(n.astype(np.float64))
    norm = np.sqrt(np.bincount(row, value * value, len(rows) - 1))
    return slot, value / norm[row], np.searchsorted(row, np.arange(len(rows)))


class Ftrl:
    """Per-coordinate follow-the-regularised-leader with L1 and L2 terms; the last slot is the bias."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int, weight: float = 1.0) -> None:
        at, x = np.append(slots, len(self.z) - 1), np.append(values, 1.0)
        w = self.weights(at)
        g = weight * (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        more = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = more


def _vectors(bits: int):
    def run(batches):
        for b in C.slices(batches, most=1 << 20):
            slot, value, at = features(b.column("text"), bits)
            put = lambda x: [x[i:j].tobytes() for i, j in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([b.column("draw"), b.column("quality"), pa.array(put(slot.astype(np.int32)), pa.binary()), pa.array(put(value.astype(np.float32)), pa.binary())], ["draw", "quality", "slots", "vals"])
    return run


def _train(bits: int, epochs: int):
    def run(batches):
        rows = [r for b in batches for r in zip(b.column("draw").to_pylist(), b.column("quality").to_pylist(), b.column("slots").to_pylist(), b.column("vals").to_pylist())]
        model, ones = Ftrl(1 << bits), sum(r[1] for r in rows)
        rare = int(2 * ones <= len(rows))  # the label with fewer rows weighs more, up to RARE times
        weight = {1 - rare: 1.0, rare: min(RARE, len(rows) / max(1, min(ones, len(rows) - ones)) - 1)}
        rows = [(y, np.frombuffer(s, np.int32), np.frombuffer(v, np.float32).astype(float)) for _, y, s, v in sorted(rows)]
        for _ in range(epochs):
            for y, s, v in rows:
                model.learn(s, v, y, weight[y])
        yield pa.RecordBatch.from_arrays([pa.array([model.weights(slice(None)).astype(np.float32).tobytes()], pa.binary())], ["weights"])
    return run


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, sample: int = SAMPLE, epochs: int = EPOCHS, folds: int = FOLDS, test_fold: int = TEST_FOLD) -> np.ndarray:
    """Weights (2 ** bits and a bias), learnt from at most `sample` labelled rows, drawn by hash, whose crc32(doc_id as text) mod `folds` is not `test_fold`.

    Labels other than 0 and 1 and null ids are left out; of contradicting labels of one id the larger counts. With no
    labelled row all weights are 0. A repeated id may bring several rows; the bound holds for rows."""
    drawn = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where(F.col("quality").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != test_fold))
             .join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")  # labels without a document use up no part of the sample
             .groupBy("doc_id").agg(F.max("quality").alias("quality"), F.xxhash64("doc_id").alias("draw")).orderBy("draw", "doc_id").limit(sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id").select("draw", "quality", "text")  # at most `sample` rows of three numbers
    vectors = rows.mapInArrow(_vectors(bits), "draw long, quality int, slots binary, vals binary").orderBy("draw", "slots").limit(sample)
    found = vectors.repartition(1).mapInArrow(_train(bits, epochs), "weights binary").collect()
    return np.frombuffer(found[0][0], np.float32).astype(float) if found else np.zeros((1 << bits) + 1)


def probabilities(texts: pa.Array, weights: np.ndarray, bits: int = BITS) -> np.ndarray:
    slot, value, at = features(texts, bits)
    sums = np.zeros(len(slot) + 1)
    np.cumsum(weights[slot] * value, out=sums[1:])
    return 1 / (1 + np.exp(-np.clip(sums[at[1:]] - sums[at[:-1]] + weights[-1], -35, 35)))


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, folds: int = FOLDS, test_fold: int = TEST_FOLD) -> DataFrame:
    """One row for each row of (doc_id, text): doc_id, held_out, score, predicted. Null and empty texts get the bias alone, repeated rows the same score each, a very long text one of its whole; other columns are not read; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** bits numbers, whatever the input

    def run(batches):
        for b in C.slices(batches, most=1 << 20):
            p = probabilities(b.column("text"), shared.value, bits)
            held = C.remainders(b.column("doc_id").to_pylist(), folds) == test_fold
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(held), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, weights: np.ndarray, bits: int = BITS, least: float = 0.5) -> DataFrame:
    """The rows, with all their columns, that score at least `least`. A null or empty text scores as the bias alone; an empty table gives an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for b in C.slices(batches, most=1 << 20):
            yield b.filter(pa.array(probabilities(b.column("text"), shared.value, bits) >= least))

    return docs.mapInArrow(run, docs.schema)
