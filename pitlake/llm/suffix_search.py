"""Benchmark passages in training text, by sorted places of the training shards.

A shard is a bounded stretch of documents. Its places are sorted by 16 bits each of the four words that begin
there; the start of every whole window of the benchmark items is binary-searched in that order, and all places
of its range are compared on, word by word, through the window. Places that share four opening words are held
at once, so a word repeated through a long document and an item costs memory by the product. The
items go to all tasks; they are cut into blocks of bounded size, so that a broadcast is bounded as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_values, kept, mapped, raw, slices, text_frame, union, words

WINDOW = 10
BLOCK_WORDS = 2_000_000  # of benchmark text in one broadcast: 16 MB of hashes, and as much for owners
FOUND = "doc_id long, n_words long, n_hit long, spans array<struct<start: long, end: long>>, matches array<struct<item_id: long, word: long, doc_word: long, length: long>>"


def word_separator() -> np.ndarray:
    """Separators of lower-cased words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+; capitals count as their small letters."""
    separator = np.ones(256, np.bool_)
    separator[0x30:0x3A] = separator[0x61:0x7B] = separator[0x41:0x5B] = separator[0x80:] = False
    return separator


def item_words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = raw(batch.column("text"))
    hashes, owner, _, _ = words(data, offsets, word_separator(), byte_values(True))
    return hashes, owner


class Items:
    """Words of benchmark items, and the first word of each of their windows."""

    def __init__(self, ids: np.ndarray, hashes: np.ndarray, owner: np.ndarray, window: int):
        self.ids, self.hashes, self.owner = ids, hashes, owner
        first = np.searchsorted(owner, np.arange(len(ids) + 1))
        length = np.diff(first)
        place = np.arange(len(hashes)) - first[owner]
        size = np.minimum(length, window)
        self.first = first
        starts = np.flatnonzero(place + size[owner] <= length[owner])
        self.starts, self.sizes = starts, size[owner[starts]]


def leading(hashes: np.ndarray, shift: int) -> np.ndarray:
    """16 bits each of a word and the three after it; past the end, zeros."""
    key = np.zeros(len(hashes), np.uint64)
    for i in range(4):
        key <<= np.uint64(16)
        if len(hashes) > shift + i:
            key[: len(hashes) - shift - i] |= hashes[shift + i :] >> np.uint64(48)
    return key


def matches_in_shard(items: Items, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window's index, first word in the shard, words matched) of every place where a whole window stands."""
    none = np.zeros(0, np.int64)
    if not len(hashes) or not len(items.starts):
        return none, none, none
    key = leading(hashes, 0)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    # Each distinct start of a window is searched once. Items of under four words bound a range of keys.
    wanted = leading(items.hashes, 0)[items.starts]
    known = np.minimum(items.sizes, 4).astype(np.uint64)
    tail = (np.uint64(4) - known) * np.uint64(16)
    low = (wanted >> tail) << tail
    high = low | ((np.uint64(1) << tail) - np.uint64(1))
    left = np.searchsorted(sorted_key, low, "left")
    right = np.searchsorted(sorted_key, high, "right")
    count = right - left
    hit = np.flatnonzero(count)
    window = np.repeat(hit, count[hit])
    base = np.repeat(np.cumsum(count[hit]) - count[hit], count[hit])
    place = order[np.repeat(left[hit], count[hit]) + np.arange(len(window)) - base]
    # Word by word with the full hashes, inside one document and the item.
    size = items.sizes[window]
    alive = place + size <= len(hashes)
    window, place, size = window[alive], place[alive], size[alive]
    alive = owner[place] == owner[place + size - 1]
    window, place, size = window[alive], place[alive], size[alive]
    for i in range(int(items.sizes.max())):
        begin = items.starts[window]
        more = np.minimum(i, size - 1)
        same = hashes[place + more] == items.hashes[begin + more]
        window, place, size = window[same], place[same], size[same]
    return window, place, size


def longest(items: Items, window: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Overlapping windows of one item on one diagonal, joined: rows (item, item's word, shard's word, length)."""
    if not len(window):
        return np.zeros((0, 4), np.int64)
    begin = items.starts[window]
    item = items.owner[begin]
    diagonal = place - begin
    order = np.lexsort((place, diagonal, item))
    item, diagonal, place, size, begin = item[order], diagonal[order], place[order], size[order], begin[order]
    new = np.ones(len(item), np.bool_)
    new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(item)) - 1
    return np.column_stack((item[at], begin[at] - items.first[item[at]], place[at], place[last] + size[last] - place[at]))


def searcher(blocks: list, window: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = [Items(*block.value, window) for block in blocks]
        separator, values = word_separator(), byte_values(True)
        for batch in slices(batches):
            data, offsets = raw(batch.column("text"))
            hashes, owner, _, _ = words(data, offsets, separator, values)
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            found, ids = [np.zeros((0, 4), np.int64)], [np.zeros(0, np.int64)]
            for items in every:
                joined = longest(items, *matches_in_shard(items, hashes, owner))
                found.append(joined)
                ids.append(items.ids[joined[:, 0]])
            found, ids = np.concatenate(found), np.concatenate(ids)
            row = owner[found[:, 2]] if len(found) else np.zeros(0, np.int64)
            order = np.lexsort((found[:, 1], ids, row))
            found, ids, row = found[order], ids[order], row[order]
            spans, matches, n_hit = [], [], np.zeros(batch.num_rows, np.int64)
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for i in range(batch.num_rows):
                part, item = found[cut[i] : cut[i + 1]], ids[cut[i] : cut[i + 1]]
                if not len(part):
                    spans.append([])
                    matches.append([])
                    continue
                place = part[:, 2] - first[i]
                covered = union(np.column_stack((place, place + part[:, 3])))
                n_hit[i] = int((covered[:, 1] - covered[:, 0]).sum())
                spans.append([{"start": int(a), "end": int(b)} for a, b in covered])
                matches.append([{"item_id": int(d), "word": int(m[1]), "doc_word": int(p), "length": int(m[3])} for d, m, p in zip(item, part, place, strict=True)])
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(n_hit),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(matches, pa.list_(pa.struct([(x, pa.int64()) for x in ("item_id", "word", "doc_word", "length")]))),
                ],
                names=["doc_id", "n_words", "n_hit", "spans", "matches"],
            )

    return search


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(item_ids, word hashes, item's index of each word) in blocks of about block_words; a long item is a block of its own."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, owner = item_words(batch)
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                names=["item_id", "hashes"],
            )

    ids, parts, size = [], [], 0

    def block() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(ids, np.int64), np.concatenate([*parts, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(parts)), [len(x) for x in parts])

    rows = mapped(text_frame(benchmark, "item_id"), hashed, "item_id long, hashes binary")
    for row in rows.toLocalIterator():
        hashes = np.frombuffer(row["hashes"], np.uint64)
        if size and size + len(hashes) > block_words:
            yield block()
            ids, parts, size = [], [], 0
        ids.append(row["item_id"])
        parts.append(hashes)
        size += len(hashes)
    if size:
        yield block()


def find_benchmark(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, covered word spans and longest verbatim matches of every document.

    A word is hit inside any occurrence of `window` consecutive item words, or of a whole shorter item.
    matches: item_id, the match's first word in the item and in the document, its length in words; runs of
    windows are one match. Null and empty texts have no words and no hits, and such items no windows.
    Repeated documents and items count each for itself; rows without an id are left out; other columns
    are ignored; an empty benchmark hits nothing. Words are compared by 64-bit hashes of their bytes,
    ten at a time, so a chance match takes ten collisions in a row; for an item of one word, one.

    A benchmark of more than block_words words is searched block by block, each over all documents, and
    the blocks' spans meet per document.
    """
    context = documents.sparkSession.sparkContext
    docs = text_frame(documents)
    passes = [mapped(docs, searcher([context.broadcast(block)], window), FOUND) for block in item_blocks(benchmark, block_words)]
    if len(passes) < 2:
        return passes[0] if passes else mapped(docs, searcher([], window), FOUND)
    # Documents may repeat an id, so passes meet on the row's number in a written copy.
    numbered = kept(docs.withColumn("row", F.monotonically_increasing_id()))
    keyed = numbered.select(F.col("row").alias("doc_id"), "text")
    passes = [mapped(keyed, searcher([context.broadcast(block)], window), FOUND) for block in item_blocks(benchmark, block_words)]
    together = passes[0]
    for other in passes[1:]:
        together = together.unionByName(other)
    merged = together.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.sort_array(F.flatten(F.collect_list("matches"))).alias("matches"),
    )

    def join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [union(np.array([(s["start"], s["end"]) for s in x], np.int64).reshape(-1, 2)) for x in batch.column("spans").to_pylist()]
            hit = [int((x[:, 1] - x[:, 0]).sum()) for x in spans]
            spans = [[{"start": int(a), "end": int(b)} for a, b in x] for x in spans]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(hit, pa.int64()), pa.array(spans, kind), batch.column("matches")],
                names=["doc_id", "n_words", "n_hit", "spans", "matches"],
            )

    joined = mapped(merged, join_spans, FOUND).withColumnRenamed("doc_id", "row")
    return joined.join(numbered.select("row", "doc_id"), "row").select("doc_id", "n_words", "n_hit", "spans", "matches")


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all columns, in which no benchmark window stands; a repeated doc_id goes if one of its texts is hit."""
    hit = find_benchmark(documents, benchmark, window).where("n_hit > 0").select(F.col("doc_id").alias("_hit_id")).distinct()
    return documents.join(hit, documents["doc_id"].cast("long") == F.col("_hit_id"), "left_anti")


def digest_of_items(column: str = "matches"):
    """SHA-256 of the matched item_ids, sorted as strings and joined by commas."""
    ids = F.array_sort(F.array_distinct(F.transform(column, lambda match: match["item_id"].cast("string"))))
    return F.size(ids).cast("long"), F.sha2(F.array_join(ids, ",").cast("binary"), 256)
