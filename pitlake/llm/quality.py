"""Quality of documents: random-indexing word vectors, pooled, into a small network with calibrated probabilities.

A word has a bucket of its hash and a bucket of its shape (kinds of characters, and whether it repeats the word
before). Every bucket has a sparse random index vector; a bucket's context vector is the sum of its
neighbours' index vectors over all documents, whole numbers that any order of adding leaves the same. A
document is the mean of its words' context vectors, of its shapes' context and index vectors, and its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_values, mapped, mix, raw, sample_of, slices, text_frame, white_space, words

WORD_BUCKETS = 4096
SHAPE_BUCKETS = 1024
DIMENSIONS = 48
NONZERO = 4
PIECES = 32  # rows that a matrix of vectors is shuffled in
FAN_IN = 64  # matrices added up by one task
TRAIN_ROWS = 20_000  # labelled documents the network is fitted on, at most; those of the least hashes
HIDDEN = 32
EPOCHS = 60


def index_vectors(buckets: int) -> np.ndarray:
    """For each bucket NONZERO distinct dimensions, half of them +1 and half -1."""
    rng = np.random.default_rng(buckets)
    vectors = np.zeros((buckets, DIMENSIONS), np.int8)
    chosen = rng.random((buckets, DIMENSIONS)).argsort(axis=1)[:, :NONZERO]
    vectors[np.arange(buckets)[:, None], chosen] = np.where(np.arange(NONZERO) % 2, 1, -1)
    return vectors


def char_kinds() -> np.ndarray:
    """One value for small letters and all bytes of other scripts, one for capitals, one for digits; marks have their own."""
    kinds = np.arange(256)
    kinds[97:123] = kinds[128:] = 97
    kinds[65:91] = 65
    kinds[48:58] = 48
    return kinds


def buckets_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, shape bucket, row) of every word."""
    data, offsets = raw(batch.column("text"))
    hashes, owner, start, end = words(data, offsets, white_space(), byte_values(True))
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), owner
    kind = char_kinds()[data]
    value = mix((kind + 1).astype(np.uint64))
    value[1:][kind[1:] == kind[:-1]] = 0
    first = mix((kind[start] + 1).astype(np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
    shape = mix(sums[end] - sums[start + 1] + first * np.uint64(3))
    again = np.zeros(len(hashes), np.bool_)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    shape = shape + again.astype(np.uint64) * np.uint64(0x5851F42D4C957F2D)
    return (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), (mix(shape) % np.uint64(SHAPE_BUCKETS)).astype(np.int64), owner


def cooccurrence(bucket: np.ndarray, owner: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each bucket the sum of index vectors of the words next to it."""
    size = len(index)
    places = np.argsort(np.abs(index), axis=1, kind="stable")[:, -NONZERO:]
    signs = np.take_along_axis(index, places, axis=1)
    out = np.zeros(size * DIMENSIONS)
    same = owner[1:] == owner[:-1]
    left, right = bucket[:-1][same], bucket[1:][same]
    for a, b in ((left, right), (right, left)):
        for k in range(NONZERO):
            out += np.bincount(a * DIMENSIONS + places[b, k], signs[b, k], size * DIMENSIONS)
    return out.astype(np.int64).reshape(size, DIMENSIONS)


def context_vectors(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Context vectors of word and shape buckets over all documents, of length one (or zero)."""
    docs = text_frame(documents)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        word_index, shape_index = index_vectors(WORD_BUCKETS), index_vectors(SHAPE_BUCKETS)
        total = np.zeros((WORD_BUCKETS + SHAPE_BUCKETS, DIMENSIONS), np.int64)
        for batch in slices(batches):
            word, shape, owner = buckets_of(batch)
            total[:WORD_BUCKETS] += cooccurrence(word, owner, word_index)
            total[WORD_BUCKETS:] += cooccurrence(shape, owner, shape_index)
        pieces = np.array_split(total, PIECES)
        part = TaskContext.get().partitionId()
        codec = pa.Codec("zstd")
        yield pa.record_batch(
            [pa.array(range(PIECES), pa.int32()), pa.array([part] * PIECES, pa.int64()), pa.array([codec.compress(p.tobytes(), asbytes=True) for p in pieces], pa.binary())],
            names=["piece", "part", "body"],
        )

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        piece, part = key[0].as_py(), key[1].as_py()
        rows = len(np.array_split(np.arange(WORD_BUCKETS + SHAPE_BUCKETS), PIECES)[piece])
        codec = pa.Codec("zstd")
        total = np.zeros(rows * DIMENSIONS, np.int64)
        for body in table.column("body").to_pylist():
            total += np.frombuffer(codec.decompress(body, total.nbytes, asbytes=True), np.int64)
        return pa.table([pa.array([piece], pa.int32()), pa.array([part], pa.int64()), pa.array([codec.compress(total.tobytes(), asbytes=True)], pa.binary())], names=["piece", "part", "body"])

    schema = "piece int, part long, body binary"
    sums, parts = mapped(docs, count, schema), docs.rdd.getNumPartitions()
    while True:  # FAN_IN matrices to a task, and so on until one is left
        sums = sums.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("piece", "part").applyInArrow(add, schema)
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            break
    codec = pa.Codec("zstd")
    empty = np.array_split(np.zeros((WORD_BUCKETS + SHAPE_BUCKETS, DIMENSIONS), np.int64), PIECES)
    for row in sums.collect():  # one matrix, of a fixed size
        empty[row["piece"]] = np.frombuffer(codec.decompress(bytes(row["body"]), empty[row["piece"]].nbytes, asbytes=True), np.int64).reshape(-1, DIMENSIONS)
    total = np.concatenate(empty).astype(np.float64)
    total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    return total[:WORD_BUCKETS].astype(np.float32), total[WORD_BUCKETS:].astype(np.float32)


def pooled(batch: pa.RecordBatch, word_vectors: np.ndarray, shape_vectors: np.ndarray) -> np.ndarray:
    """A row of features for each text: three means of vectors, and the log of the number of words."""
    word, shape, owner = buckets_of(batch)
    shape_all = np.concatenate((shape_vectors, index_vectors(SHAPE_BUCKETS).astype(np.float32)), axis=1)
    first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
    out = np.zeros((batch.num_rows, 3 * DIMENSIONS + 1), np.float32)
    step = 256
    for a in range(0, batch.num_rows, step):
        b = min(a + step, batch.num_rows)
        lo, hi = first[a], first[b]
        row, n = owner[lo:hi] - a, b - a
        counts = np.maximum(np.diff(first[a : b + 1]), 1)[:, None]
        by_word = np.bincount(row * WORD_BUCKETS + word[lo:hi], minlength=n * WORD_BUCKETS).reshape(n, -1).astype(np.float32)
        by_shape = np.bincount(row * SHAPE_BUCKETS + shape[lo:hi], minlength=n * SHAPE_BUCKETS).reshape(n, -1).astype(np.float32)
        out[a:b, :DIMENSIONS] = by_word @ word_vectors / counts
        out[a:b, DIMENSIONS : 3 * DIMENSIONS] = by_shape @ shape_all / counts
    out[:, -1] = np.log1p(np.diff(first))
    return out


@dataclass
class Network:
    word_vectors: np.ndarray
    shape_vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.mean) / self.scale
        return np.tanh(x @ self.first + self.first_bias) @ self.second + self.second_bias

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(features) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def log_loss(logits: np.ndarray, labels: np.ndarray) -> float:
    p = np.clip(sigmoid(logits), 1e-9, 1 - 1e-9)
    return float(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())


def fit(features: np.ndarray, labels: np.ndarray, word_vectors: np.ndarray, shape_vectors: np.ndarray) -> Network:
    """Adam on four fifths of the rows; the temperature on the others. Without rows of both labels, the share of ones."""
    width = features.shape[1]
    rng = np.random.default_rng(7)
    if not len(labels) or labels.min() == labels.max():
        share = np.clip((labels.sum() + 0.5) / (len(labels) + 1), 1e-6, 1 - 1e-6) if len(labels) else 0.5
        return Network(word_vectors, shape_vectors, np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(np.log(share / (1 - share))), 1.0)
    shuffled = rng.permutation(len(labels))
    cut = max(1, len(labels) * 4 // 5)
    train, check = shuffled[:cut], shuffled[cut:]
    mean, scale = features[train].mean(axis=0), features[train].std(axis=0) + 1e-4
    x, y = ((features[train] - mean) / scale).astype(np.float64), labels[train].astype(np.float64)
    p = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    size = 256
    epochs = max(EPOCHS, 2000 * size // len(y) if len(y) < 2000 else 0)
    for epoch in range(min(epochs, 400)):
        order = rng.permutation(len(y))
        rate = 3e-3 * 0.5 * (1 + np.cos(np.pi * epoch / min(epochs, 400)))
        for k in range(0, len(y), size):
            rows = order[k : k + size]
            hidden = np.tanh(x[rows] @ p[0] + p[1])
            error = (sigmoid(hidden @ p[2] + p[3]) - y[rows]) / len(rows)
            back = np.outer(error, p[2]) * (1 - hidden**2)
            grads = [x[rows].T @ back + 1e-4 * p[0], back.sum(axis=0), hidden.T @ error + 1e-4 * p[2], np.array([error.sum()])]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    network = Network(word_vectors, shape_vectors, mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    if len(check) and labels[check].min() != labels[check].max():
        logits = network.logits(features[check])
        network.temperature = float(min(np.geomspace(0.25, 8, 61), key=lambda c: log_loss(logits / c, labels[check])))
    return network


def train(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Network:
    """Vectors from all documents; the network from at most train_rows of those that `labels` (doc_id, quality) marks 0 or 1."""
    word_vectors, shape_vectors = context_vectors(documents)
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((word_vectors, shape_vectors))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # The bound makes the broadcast small.
    sample = F.broadcast(sample_of(marked, train_rows, "doc_id"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = pooled(batch, *shared.value)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("quality"), pa.array([r.tobytes() for r in rows], pa.binary())],
                names=["doc_id", "quality", "features"],
            )

    rows = mapped(text_frame(documents).join(sample, "doc_id"), features, "doc_id long, quality int, features binary")
    rows = sorted(rows.collect(), key=lambda r: (r["doc_id"], bytes(r["features"])))
    width = 3 * DIMENSIONS + 1
    x = np.frombuffer(b"".join(bytes(r["features"]) for r in rows), np.float32).reshape(-1, width)
    return fit(x, np.array([r["quality"] for r in rows], np.int64), word_vectors, shape_vectors)


def score(documents: DataFrame, network: Network) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) of every document.

    Null and empty texts have no words and are scored as such. Repeated rows are scored each; rows without a
    doc_id are left out; columns besides the text play no part; an empty table gives an empty one.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(network))  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            network = Network(**shared.value)
            p = network.probabilities(pooled(batch, network.word_vectors, network.shape_vectors)).astype(np.float64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return mapped(text_frame(documents), run, "doc_id long, score double, predicted int")


def held_out(remainder: int = 1, modulus: int = 3):
    """Documents whose labels are never learnt from, by the CRC of the id's digits."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def score_held_out(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document scored by a network fitted on labels of those that aren't held out."""
    network = train(documents, labels.where(~held_out()))
    return score(documents, network).withColumn("held_out", held_out())
