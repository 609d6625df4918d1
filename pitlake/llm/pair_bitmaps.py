"""Alignment of two tokenizers: which tokens overlap, and in how many documents every pair of ids does.

Both tokenizers work between word starts, so a text is cut into chunks, each a run of blanks and what follows up to
the next blank that stands after a visible character; a chunk's tokens, groups and links are found once and remembered.
Documents are numbered within blocks. A block is an inverted index: for every pair of ids a bitmap of the documents
that hold it linked (sparse ones as lists of numbers), and over all its entries bit planes of the number of links.
Blocks hold different documents, so the corpus-wide bitmap of a pair is the blocks' side by side, and its popcount the
sum of theirs; only popcounts are shuffled by pair. The scores go back to the blocks, whose postings add them up by
document. No task holds more than a block, a pair's count or the pairs of one id.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, mapped, slices, text_frame

SHIFT = 15  # bits of a pair's key for the second tokenizer's id
BLOCK_ENTRIES = 2_000_000  # (document, pair) entries after which a block is closed
BLOCK_DOCUMENTS = 1 << 16  # numbers of documents in a block fit 16 bits
CACHE_CHUNKS, CACHE_CHARS = 300_000, 24 << 20  # what a Python worker remembers; then it starts again with none
PART = 1 << 20  # characters of a text looked at together
#: No blank after one of these starts a chunk: they may be white space to one of the tokenizers.
SPACES = r"\s\u180e\u200b\ufeff"
CHUNK = re.compile(rf" *[^ ]+(?:(?<=[{SPACES}]) +[^ ]*)*| +")
START = re.compile(rf"(?<=[^{SPACES}]) ")

DOC_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
BLOCK = (
    "block long, " + ", ".join(f"{c} array<{'string' if c == 'groups_sha256' else 'long'}>" for c in DOC_COLUMNS)
    + ", pairs array<long>, sizes array<int>, bitmaps binary, planes array<binary>"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Aligner:
    """Both tokenizers, and what is known of the chunks met so far."""

    def __init__(self, byte_level_json: str, piece_model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a, self.b = Tokenizer.from_str(byte_level_json), SentencePieceProcessor(model_proto=piece_model)
        self.a.encode_special_tokens = True
        self.bytes_a = byte_level_tokens(self.a)
        self.bytes_b = [piece_bytes(self.b, i) for i in range(self.b.get_piece_size())]
        if len(self.bytes_b) > 1 << SHIFT:
            raise ValueError(f"the second tokenizer has more than {1 << SHIFT} ids")
        self.length_a, self.length_b = (np.array([len(x) for x in tokens], np.int64) for tokens in (self.bytes_a, self.bytes_b))
        size = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [f"{i}{mark}" for i in range(size) for mark in ("", ",", "|", ";")]
        self.blank = self.b.piece_to_id("▁")
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.chars = 0
        self.counts = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links of each chunk; -1: its bytes differ
        self.first = np.zeros(1, np.int64)  # of each chunk in the two arrays below
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, chunks: list[str]) -> None:
        """Tokens, groups and links of chunks that aren't known yet; each begins with a blank."""
        ids_a = [x.ids for x in self.a.encode_batch(chunks, add_special_tokens=False)]
        ids_b = self.b.encode([x[1:] for x in chunks], num_threads=1)
        ids_b = [ids or [self.blank] for ids in ids_b]  # a lone blank: nothing is left to encode
        whole = [x.encode() for x in chunks]
        length = np.fromiter(map(len, whole), np.int64, len(whole))
        size_a, size_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in ((ids_a, size_a), (ids_b, size_b)))
        good = np.ones(len(chunks), np.bool_)
        for flat, size, tokens, lengths in ((flat_a, size_a, self.bytes_a, self.length_a), (flat_b, size_b, self.bytes_b, self.length_b)):
            good &= np.bincount(np.repeat(np.arange(len(size)), size), lengths[flat], len(size)) == length
            if b"".join(map(tokens.__getitem__, flat.tolist())) != b"".join(whole):
                stop = np.cumsum(size).tolist()
                parts = (b"".join(map(tokens.__getitem__, flat[i:j].tolist())) for i, j in zip([0, *stop], stop, strict=False))
                good &= np.fromiter((x == y for x, y in zip(parts, whole, strict=True)), np.bool_, len(whole))
        rows = np.flatnonzero(good)
        flat_a, flat_b = flat_a[np.repeat(good, size_a)], flat_b[np.repeat(good, size_b)]
        size_a, size_b = size_a[good], size_b[good]
        end_a, end_b = np.cumsum(self.length_a[flat_a]), np.cumsum(self.length_b[flat_b])
        ends = np.cumsum(length[good])
        # Between two cuts lies one token of each kind, and tokens that overlap do so between two cuts: a link each.
        cuts = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
        row = np.searchsorted(ends, cuts)
        both = (end_a[at_a] == cuts) & (end_b[at_b] == cuts) if len(cuts) else np.zeros(0, np.bool_)
        group_ends = cuts[both]
        counts = np.full((len(chunks), 4), -1, np.int64)
        counts[rows] = np.column_stack((size_a, size_b, np.bincount(row[both], minlength=len(rows)), np.bincount(row, minlength=len(rows))))
        keys = (row << 32) | (flat_a[at_a] << SHIFT) | flat_b[at_b]
        keys, times = np.unique(keys, return_counts=True)
        per_chunk = np.zeros(len(chunks), np.int64)
        per_chunk[rows] = np.bincount(keys >> 32, minlength=len(rows))
        # Groups as text: all tokens by group, those of A first, each with the mark that follows it.
        group = np.concatenate((np.searchsorted(group_ends, end_a) * 2, np.searchsorted(group_ends, end_b) * 2 + 1))
        order = np.argsort(group, kind="stable")
        group, token = group[order], np.concatenate((flat_a, flat_b))[order]
        mark = np.zeros(len(group), np.int64)
        if len(group):
            mark[:-1] = np.where(group[1:] == group[:-1], 1, np.where(group[1:] >> 1 == group[:-1] >> 1, 2, 3))
            stop = np.cumsum(size_a + size_b)
            mark[stop - 1] = 0
            written = list(map(self.written.__getitem__, (token * 4 + mark).tolist()))
            stop = stop.tolist()
            texts = ["".join(written[i:j]) for i, j in zip([0, *stop[:-1]], stop, strict=True)]
        else:
            texts = []
        known = len(self.groups)
        self.index.update(zip(chunks, range(known, known + len(chunks)), strict=True))
        named = iter(texts)
        self.groups.extend(next(named) if ok else "" for ok in good.tolist())
        self.chars += sum(map(len, chunks)) + sum(map(len, texts))
        self.counts = np.concatenate((self.counts, counts))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(per_chunk)))
        self.pairs = np.concatenate((self.pairs, keys & 0xFFFFFFFF))
        self.times = np.concatenate((self.times, times))

    def chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The known number of every chunk of the texts, in order, and how many each text has."""
        found = list(map(CHUNK.findall, texts))
        flat = list(chain.from_iterable(found))
        if len(self.index) > CACHE_CHUNKS or self.chars > CACHE_CHARS:
            self.forget()
        new = list(set(flat).difference(self.index))
        gc.disable()  # nothing here makes cycles, and looking for them among so many small lists takes a sixth of the time
        for at in range(0, len(new), 10_000):
            self.learn(new[at : at + 10_000])
        gc.enable()
        return np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat)), np.array([len(c) for c in found], np.int64)


def byte_level_tokens(tokenizer) -> list[bytes]:
    """Bytes of every id: visible bytes stand for themselves, the others for the characters from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(visible)]
    byte_of = {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(rest)}
    tokens = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        tokens[i] = bytes(byte_of[c] for c in token)
    return tokens


def piece_bytes(pieces, i: int) -> bytes:
    piece = pieces.id_to_piece(i)
    if pieces.is_byte(i):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def parts_of(text: str) -> Iterator[str]:
    """Pieces of about PART characters that end where a chunk does."""
    at = 0
    while len(text) - at > PART:
        cut = START.search(text, at + PART)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), np.bool_), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(values, first) if len(first) else values[:0]


def bitmaps_of(pair: np.ndarray, doc: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Distinct pairs, popcounts and bitmaps of entries sorted by pair and document.

    A bitmap takes a bit a document; one of few documents is a list of their numbers, 16 bits each.
    """
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(pair)), np.bool_), pair[1:] != pair[:-1])))
    sizes = np.diff(np.append(first, len(pair)))
    width = -(-documents // 8)
    full = sizes * 2 > width
    owner = np.repeat(np.arange(len(first)), sizes)
    dense = full[owner]
    row = np.cumsum(full) - 1
    bits = np.zeros((int(full.sum()), width * 8), np.bool_)
    bits[row[owner[dense]], doc[dense]] = True
    body = np.packbits(bits, axis=1, bitorder="little").tobytes() + doc[~dense].astype("<u2").tobytes()
    return pair[first], sizes, body


def documents_of(sizes: np.ndarray, documents: int, body: bytes) -> np.ndarray:
    """The entries' documents, as `bitmaps_of` was given them."""
    width = -(-documents // 8)
    full = sizes * 2 > width
    cut = int(full.sum()) * width
    bits = np.unpackbits(np.frombuffer(body, np.uint8, cut).reshape(-1, width), axis=1, bitorder="little") if cut else np.zeros((0, 0))
    dense = np.repeat(full, sizes)
    doc = np.zeros(len(dense), np.int64)
    doc[dense] = bits.nonzero()[1]
    doc[~dense] = np.frombuffer(body, "<u2", offset=cut)
    return doc


def planes_of(times: np.ndarray) -> list[bytes]:
    """Bit k of every entry's number of links is plane k."""
    codec = pa.Codec("zstd")
    bits = int(times.max()).bit_length() if len(times) else 0
    return [codec.compress(np.packbits((times >> k & 1).astype(np.bool_)).tobytes(), asbytes=True) for k in range(bits)]


def times_of(entries: int, planes: list[bytes]) -> np.ndarray:
    codec = pa.Codec("zstd")
    times = np.zeros(entries, np.int64)
    for k, plane in enumerate(planes):
        raw = codec.decompress(plane, -(-entries // 8), asbytes=True)
        times |= np.unpackbits(np.frombuffer(raw, np.uint8), count=entries).astype(np.int64) << k
    return times


class Index:
    """A block that is being filled."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.counts: list[np.ndarray] = []
        self.digests: list[str] = []
        self.keys: list[np.ndarray] = []  # pair << 16 | document
        self.times: list[np.ndarray] = []
        self.entries = 0

    def add(self, aligner: Aligner, ids: list[int], texts: list[str]) -> None:
        """Documents with their whole texts."""
        counts, bad = np.zeros((len(ids), 4), np.int64), np.array([not text for text in texts], np.bool_)
        digests: list = [None] * len(ids)
        keys, times = [], []
        for numbers, parts in some_at_once(texts):
            chunk, sizes = aligner.chunks(parts)
            doc = np.repeat(np.array(numbers, np.int64), sizes)
            found = aligner.counts[chunk]
            bad[doc[found[:, 0] < 0]] = True
            np.add.at(counts, doc, found)
            flat, at = chunk.tolist(), 0
            for n, size in zip(numbers, sizes.tolist(), strict=True):
                text = ";".join([aligner.groups[c] for c in flat[at : at + size]])
                at += size
                if digests[n] is None:
                    digests[n] = hashlib.sha256(text.encode())
                else:
                    digests[n].update(f";{text}".encode())
            both, repeats = np.unique(doc << 32 | chunk, return_counts=True)
            doc, chunk = both >> 32, both & 0xFFFFFFFF
            links = aligner.first[chunk + 1] - aligner.first[chunk]
            place = np.arange(links.sum()) + np.repeat(aligner.first[chunk] - np.cumsum(links) + links, links)
            key = aligner.pairs[place] << 16 | np.repeat(doc, links) + len(self.ids)
            key, time = summed(key, aligner.times[place] * np.repeat(repeats, links))
            keys.append(key)
            times.append(time)
        counts[bad] = 0
        lost = np.flatnonzero(bad) + len(self.ids)
        for key, time in zip(keys, times, strict=True):
            stays = ~np.isin(key & 0xFFFF, lost)
            self.keys.append(key[stays])
            self.times.append(time[stays])
            self.entries += int(stays.sum())
        self.ids.extend(ids)
        self.counts.append(counts)
        self.digests.extend("" if gone else digest.hexdigest() for gone, digest in zip(bad.tolist(), digests, strict=True))

    def closed(self, block: int) -> pa.RecordBatch:
        """The block's row. Entries of one document from several parts of its text become one."""
        key, times = summed(np.concatenate([*self.keys, np.zeros(0, np.int64)]), np.concatenate([*self.times, np.zeros(0, np.int64)]))
        pairs, sizes, bitmaps = bitmaps_of(key >> 16, key & 0xFFFF, len(self.ids))
        counts = np.concatenate(self.counts)
        long = pa.list_(pa.int64())
        values = [self.ids, *counts.T]
        return pa.record_batch(
            [
                pa.array([block], pa.int64()), *(pa.array([v], long) for v in values), pa.array([self.digests], pa.list_(pa.string())),
                pa.array([pairs], long), pa.array([sizes], pa.list_(pa.int32())), pa.array([bitmaps], pa.binary()),
                pa.array([planes_of(times)], pa.list_(pa.binary())),
            ],
            names=["block", *DOC_COLUMNS, "pairs", "sizes", "bitmaps", "planes"],
        )


def some_at_once(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers of texts and parts of them, about PART characters together; a blank stands before every text."""
    numbers, parts, size = [], [], 0
    for n, text in enumerate(texts):
        for part in parts_of(f" {text}") if text else ():
            numbers.append(n)
            parts.append(part)
            size += len(part)
            if size >= PART:
                yield numbers, parts
                numbers, parts, size = [], [], 0
    if numbers:
        yield numbers, parts


def blocks_of(documents: DataFrame, byte_level_json: str, piece_model: str) -> DataFrame:
    """A row per block: its documents with their own figures, and its inverted index. A written table."""
    spark = documents.sparkSession
    with open(byte_level_json, encoding="utf-8") as a, open(piece_model, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))  # the vocabularies, whatever the documents are

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        aligner, filling = None, Index()
        for batch in slices(batches):
            aligner = aligner or Aligner(*files.value)
            if len(filling.ids) and (filling.entries >= BLOCK_ENTRIES or len(filling.ids) + batch.num_rows > BLOCK_DOCUMENTS):
                yield filling.closed(block)
                block, filling = block + 1, Index()
            for at in range(0, batch.num_rows, BLOCK_DOCUMENTS):
                some = batch.slice(at, BLOCK_DOCUMENTS)
                if at:
                    yield filling.closed(block)
                    block, filling = block + 1, Index()
                filling.add(aligner, some.column("doc_id").to_pylist(), some.column("text").to_pylist())
        if filling.ids:
            yield filling.closed(block)

    return kept(mapped(text_frame(documents), index, BLOCK))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, n_documents that hold it linked, and whether no other pair of its first id has more."""
    popcounts = blocks.select(F.explode(F.arrays_zip("pairs", "sizes")).alias("x")).select("x.pairs", "x.sizes")
    counts = popcounts.groupBy(F.col("pairs").alias("pair")).agg(F.sum("sizes").alias("n_documents"))
    # The pairs of one id are no more than the other vocabulary has.
    of_id = Window.partitionBy(F.shiftright("pair", SHIFT))
    return counts.withColumn("best", F.col("n_documents") == F.max("n_documents").over(of_id))


def scores_of(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """Every document's own figures, n_best and count_sum, added up from its block's postings."""
    listed = blocks.select(F.col("block").alias("of_block"), F.explode("pairs").alias("pair"))
    scored = listed.join(counts, "pair").select("of_block", "pair", "n_documents", "best")

    def score(postings: pa.Table, pairs: pa.Table) -> pa.Table:
        row = {name: postings.column(name)[0] for name in postings.column_names}
        documents = len(row["doc_id"])
        order = np.argsort(pairs.column("pair").to_numpy(), kind="stable")
        count = pairs.column("n_documents").to_numpy()[order]
        best = pairs.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        sizes = row["sizes"].values.to_numpy().astype(np.int64)
        doc = documents_of(sizes, documents, row["bitmaps"].as_py()) if len(sizes) else np.zeros(0, np.int64)
        times = times_of(len(doc), row["planes"].as_py())
        n_best, count_sum = np.zeros(documents, np.int64), np.zeros(documents, np.int64)
        np.add.at(count_sum, doc, times * np.repeat(count, sizes))
        np.add.at(n_best, doc, times * np.repeat(best, sizes))
        own = {name: row[name].values for name in DOC_COLUMNS}
        return pa.table(own | {"n_best": n_best, "count_sum": count_sum}).select([field.split()[0] for field in RESULT.split(", ")])

    return blocks.groupBy("block").cogroup(scored.groupBy("of_block")).applyInArrow(score, RESULT)


def align(documents: DataFrame, byte_level_json: str, piece_model: str) -> tuple[DataFrame, DataFrame]:
    """(document figures, pairs): how the tokens of a byte-level tokenizer (A) and of a piece tokenizer (B) overlap.

    A encodes a blank and the text, B the text, before which it sets a blank itself; special tokens are none. Figures:
    doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; pairs: id_a, id_b, n_documents, best.
    A null or empty text, or one whose bytes B changes (it holds U+2581), has zeros, '' and no links. Every row is a
    document, rows with one doc_id too; rows without a doc_id are left out; other columns play no part; an
    empty table gives empty ones.
    """
    blocks = blocks_of(documents, byte_level_json, piece_model)
    counts = pair_counts(blocks)
    pairs = counts.select(
        F.shiftright("pair", SHIFT).cast("int").alias("id_a"), F.col("pair").bitwiseAND((1 << SHIFT) - 1).cast("int").alias("id_b"), "n_documents", "best"
    )
    return scores_of(blocks, counts), pairs
