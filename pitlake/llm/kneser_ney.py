"""Interpolated modified Kneser-Ney language model of order two.

Counted in Spark: each batch packs its distinct (context, word) pairs by shard, shards add them up, and the
words' continuation counts meet in a second, smaller shuffle. Shards are written to the shared folder as sorted
arrays of hashes beside their counts; workers map them into memory, so that a task holds what it touches.
Order two is what the check's disk budget bears; see the README.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_values, kept, mapped, mix, raw, shared_dir, slices, text_frame, white_space, words

BEGIN, END = np.uint64(1), np.uint64(2)  # marks of a text's begin and end; words' hashes are over these
SHARD_BYTES = 8 << 20  # of text for a shard
MAX_SHARDS = 4096
BATCH_BYTES = 32 << 20
PACKED = "shard int, body binary, size long"


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, token, row) of every word and text end: 48-bit hashes, in order."""
    data, offsets = raw(batch.column("text"))
    hashes, owner, _, _ = words(data, offsets, white_space(), byte_values(True))
    hashes = np.maximum(hashes >> np.uint64(16), np.uint64(3))
    rows = batch.num_rows
    ends = np.searchsorted(owner, np.arange(rows), "right")
    token = np.insert(hashes, ends, END)
    row = np.insert(owner, ends, np.arange(rows))
    context = np.concatenate(([BEGIN], token[:-1]))[: len(token)]
    context[context == END] = BEGIN
    return context, token, row


def pair_hash(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(mix(context) + token)


def six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_six(x: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(x) // 6, 8), np.uint8)
    wide[:, :6] = x.reshape(-1, 6)
    return wide.view("<u8").ravel()


def pack(*columns: np.ndarray) -> tuple[bytes, int]:
    """48-bit and 32-bit columns, compressed; the first is sorted."""
    body = b"".join(six(c) if c.dtype == np.uint64 else c.astype("<u4").tobytes() for c in columns)
    return pa.Codec("zstd", 1).compress(body, asbytes=True), len(body)


def unpack(body: bytes, size: int, kinds: list) -> list[np.ndarray]:
    data = np.frombuffer(pa.Codec("zstd").decompress(body, size, asbytes=True), np.uint8)
    n = size // sum(6 if k == np.uint64 else 4 for k in kinds)
    out, at = [], 0
    for kind in kinds:
        width = 6 if kind == np.uint64 else 4
        part = data[at : at + n * width]
        out.append(from_six(part) if kind == np.uint64 else part.view("<u4").astype(np.int64))
        at += n * width
    return out


def added(keys: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return [keys[start], *(np.add.reduceat(c[order], start) if len(start) else c[:0] for c in counts)]


def packed_rows(shard: np.ndarray, columns: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """A row for each shard that has any; `columns` are sorted by shard."""
    cut = np.searchsorted(shard, np.arange(shards + 1))
    present = np.flatnonzero(np.diff(cut))
    bodies = [pack(*(c[cut[s] : cut[s + 1]] for c in columns)) for s in present]
    return pa.record_batch(
        [pa.array(present, pa.int32()), pa.array([b for b, _ in bodies], pa.binary()), pa.array([n for _, n in bodies], pa.int64())],
        names=["shard", "body", "size"],
    )


def write_array(folder: str, name: str, array: np.ndarray) -> None:
    """Whole or not at all, also when a task runs twice."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/.{name}-{uuid.uuid4().hex}"
    np.save(path, array)
    os.replace(f"{path}.npy", f"{folder}/{name}.npy")


def local_path(path: str) -> str:
    """The folder as a mounted path, which memory maps need."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"the model is mapped into memory, so the shared folder must be mounted; {path} isn't")
    return parsed.path


def gather(batches: pa.Table, kinds: list) -> list[np.ndarray]:
    parts = [unpack(b, n, kinds) for b, n in zip(batches.column("body").to_pylist(), batches.column("size").to_pylist(), strict=True)]
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of grams counted 1, 2, 3 and 4 times; bounded where those are few."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    found = [k - (k + 1) * y * b / a if a else y for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
    return tuple(min(max(d, 0.1), k - 0.1) for k, d in enumerate(found, 1))


def discount_of(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(count, 3)]


#: Written beside the arrays once all of them are.
MARK = "whole"


@dataclass
class Model:
    folder: str
    shards: int
    train_tokens: int
    vocabulary: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    pairs: int
    word_kinds: tuple[int, int, int]  # words continued once, twice, oftener


def train(documents: DataFrame, shards: int | None = None) -> Model:
    """The model of the texts of `documents`, written to the shared folder."""
    docs = text_frame(documents)
    spark = docs.sparkSession
    folder = local_path(shared_dir(spark))
    if shards is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = min(MAX_SHARDS, max(1, size // SHARD_BYTES))

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=BATCH_BYTES):
            context, token, _ = tokens(batch)
            _, first, times = np.unique(pair_hash(context, token), return_index=True, return_counts=True)
            context, token = context[first], token[first]
            shard = (mix(context) % np.uint64(shards)).astype(np.int64)
            order = np.lexsort((token, context, shard))
            yield packed_rows(shard[order], [context[order], token[order], times[order].astype(np.uint32)], shards)

    def add_pairs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        context, token, times = gather(table, [np.uint64, np.uint64, np.uint32])
        order = np.lexsort((token, context))
        context, token, times = context[order], token[order], times[order]
        start = np.flatnonzero(np.concatenate(([True], (context[1:] != context[:-1]) | (token[1:] != token[:-1]))))
        context, token, times = context[start], token[start], np.add.reduceat(times, start)
        head = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
        write_array(folder, f"context-{shard}", context[head])
        kinds = [np.add.reduceat(x.astype(np.int64), head) for x in (times, times == 1, times == 2, times > 2)]
        write_array(folder, f"context-counts-{shard}", np.column_stack(kinds).astype(np.uint32))
        pair = pair_hash(context, token)
        order = np.argsort(pair)
        write_array(folder, f"pair-{shard}", pair[order])
        write_array(folder, f"pair-count-{shard}", times[order].astype(np.uint8 if times.max() < 256 else np.uint32))
        word, followed, total = added(token, np.ones(len(token), np.int64), times)
        part = (mix(word) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        rows = packed_rows(part[order], [word[order], followed[order].astype(np.uint32), total[order].astype(np.uint32)], shards)
        nothing = [pa.array([0] * rows.num_rows, pa.int64())] * 5
        out = pa.table([*rows.columns, *nothing], names=["shard", "body", "size", "n1", "n2", "n3", "n4", "pairs"])
        counted = [int((times == k).sum()) for k in range(1, 5)]
        total = pa.table([[-1], [b""], [0], *([n] for n in counted), [len(pair)]], names=out.column_names).cast(out.schema)
        return pa.concat_tables([out, total])

    def add_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        word, followed, total = added(*gather(table, [np.uint64, np.uint32, np.uint32]))
        shard = key[0].as_py()
        write_array(folder, f"word-{shard}", word)
        write_array(folder, f"word-counts-{shard}", np.column_stack((followed, total)).astype(np.uint32))
        values = [int((followed == k).sum()) for k in range(1, 5)] + [int((followed > 2).sum()), len(word), int(total.sum())]
        return pa.table([[v] for v in values], names=["n1", "n2", "n3", "n4", "many", "words", "tokens"])

    fields = "n1 long, n2 long, n3 long, n4 long"
    pairs = mapped(docs, count_pairs, PACKED).groupBy("shard").applyInArrow(add_pairs, f"{PACKED}, {fields}, pairs long")
    pairs = kept(pairs)
    sums = pairs.where("shard = -1").groupBy().sum("n1", "n2", "n3", "n4", "pairs").first()
    parts = pairs.where("shard >= 0").select("shard", "body", "size").groupBy("shard")
    word_sums = parts.applyInArrow(add_words, f"{fields}, many long, words long, tokens long").groupBy().sum().first()
    sums, word_sums = [x or 0 for x in sums], [x or 0 for x in word_sums]
    write_array(folder, MARK, np.array([shards]))
    return Model(
        folder, int(shards), word_sums[6], word_sums[5], discounts(sums[:4]), discounts(word_sums[:4]), sums[4],
        (word_sums[0], word_sums[1], word_sums[4]),
    )


def find(array: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, found) of sorted `wanted` in a sorted array."""
    if not len(array):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.bool_)
    at = np.minimum(np.searchsorted(array, wanted), len(array) - 1)
    return at, array[at] == wanted


class Reader:
    """Looks the model's counts up in its mapped arrays."""

    def __init__(self, model: Model):
        self.model = model
        self.maps: dict[str, np.ndarray] = {}

    def map(self, name: str, shard: int) -> np.ndarray:
        key = f"{name}-{shard}"
        if key not in self.maps:
            path = f"{self.model.folder}/{key}.npy"
            # A shard without rows has no file; where the mark isn't seen either, the folder isn't shared.
            if not os.path.exists(path) and not os.path.exists(f"{self.model.folder}/{MARK}.npy"):
                raise FileNotFoundError(f"this worker doesn't see the model in {self.model.folder}")
            self.maps[key] = np.load(path, mmap_mode="r") if os.path.exists(path) else np.zeros((0, 4) if "counts" in name else 0, np.uint32)
        return self.maps[key]

    def look(self, keys: np.ndarray, by: np.ndarray, name: str, values: str, width: int) -> np.ndarray:
        """Values of distinct keys, zeros where there is none; `by` deals them to shards."""
        shard = (mix(by) % np.uint64(self.model.shards)).astype(np.int64)
        out = np.zeros((len(keys), width), np.int64)
        order = np.lexsort((keys, shard))
        cut = np.searchsorted(shard[order], np.arange(self.model.shards + 1))
        for s in np.flatnonzero(np.diff(cut)):
            own = order[cut[s] : cut[s + 1]]
            at, good = find(self.map(name, s), keys[own])
            if good.any():
                out[own[good]] = np.reshape(self.map(values, s)[at[good]], (-1, width))
        return out

    def word_counts(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Continuation count and count of distinct words."""
        found = self.look(word, word, "word", "word-counts", 2)
        return found[:, 0], found[:, 1]

    def word_probability(self, followed: np.ndarray) -> np.ndarray:
        m = self.model
        if not m.pairs:
            return np.ones(len(followed))
        rest = sum(d * n for d, n in zip(m.word_discounts, m.word_kinds, strict=True)) / m.pairs
        return (followed - discount_of(followed, m.word_discounts)) / m.pairs + rest / (m.vocabulary + 1)

    def log_probabilities(self, context: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of each token's probability after its context, and its count in training."""
        words, word_at = np.unique(token, return_inverse=True)
        followed, count = self.word_counts(words)
        word = self.word_probability(followed)
        contexts, context_at = np.unique(context, return_inverse=True)
        counts = self.look(contexts, contexts, "context", "context-counts", 4)
        total, kinds = counts[:, 0], counts[:, 1:]
        d = np.array(self.model.pair_discounts)
        seen = total > 0
        rest = np.where(seen, kinds @ d / np.maximum(total, 1), 1.0)
        pairs, first, pair_at = np.unique(pair_hash(context, token), return_index=True, return_inverse=True)
        times = self.look(pairs, context[first], "pair", "pair-count", 1)[:, 0]
        own = (times - discount_of(times, self.model.pair_discounts)) / np.maximum(total[context_at[first]], 1)
        p = own + rest[context_at[first]] * word[word_at[first]]
        return np.log10(p)[pair_at], count[word_at]


_readers: dict[str, Reader] = {}


def reader_for(model: Model) -> Reader:
    if model.folder not in _readers:
        _readers.clear()  # a worker may serve one model after another
        _readers[model.folder] = Reader(model)
    return _readers[model.folder]


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score and perplexity of every document.

    score: the sum of log10 probabilities of a text's words and its end. base_score: that of single words with
    half a count added. Null and empty texts are the end alone. Without training text, every token has the
    probability 1. Repeated rows are scored each; rows without a doc_id are left out; other columns are
    ignored; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = reader_for(model)
        for batch in slices(batches):
            context, token, row = tokens(batch)
            log, count = reader.log_probabilities(context, token)
            base = np.log10((count + 0.5) / (model.train_tokens + 0.5 * (model.vocabulary + 1)))
            start = np.searchsorted(row, np.arange(batch.num_rows))
            n = np.diff(np.append(start, len(row)))
            total = np.add.reduceat(log, start)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(n),
                    pa.array(np.add.reduceat((count > 0).astype(np.int64), start)),
                    pa.array(np.full(len(n), model.train_tokens, np.int64)),
                    pa.array(np.add.reduceat(base, start)),
                    pa.array(total),
                    pa.array(10 ** (-total / n)),
                ],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    return mapped(text_frame(documents), run, SCORES)


def held_out(remainder: int = 1, modulus: int = 5):
    """Documents kept out of training, by the CRC of the id's digits."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def score_held_out(documents: DataFrame) -> DataFrame:
    """Every document scored by a model of those that aren't held out."""
    model = train(documents.where(~held_out()))
    return score(documents, model).withColumn("held_out", held_out())
