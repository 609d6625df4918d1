"""Byte-level BPE with given ranks: text to ids as the tiktoken library encodes it, and back.

Each match of the split pattern is encoded separately. Over its byte positions stands a segment tree
whose leaves hold the rank of the pair that begins there; a node holds the leftmost minimum below it.
A merge takes the root's pair, and updates two leaves (the merged part's pair and the pair of the live
neighbour before it) and clears one, each along one path to the root. Pieces of a batch whose trees have the
same size are merged side by side as rows of one array.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import mapped, slices, text_frame

CACHE_WORDS = 300_000  # words with their ids that a Python worker remembers; then it starts again with none
TREE_LEAVES = 1 << 17  # leaves of the trees merged side by side
MARKS = tuple(".,;:!?")
NO_RANK = np.int64(1) << np.int64(40)


class Vocabulary:
    """Token bytes by id, and the rank of every pair of tokens whose bytes together are a token."""

    def __init__(self, ranks: bytes):
        """ranks: lines of base64 token, space, rank, as tiktoken's files have them; all 256 bytes are tokens."""
        self.rank = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line.strip())}
        self.size = max(self.rank.values()) + 1
        token = {rank: token for token, rank in self.rank.items()}
        tokens = [token.get(i, b"") for i in range(self.size)]
        self.bytes = Ids(np.array([len(x) for x in tokens]), np.frombuffer(b"".join(tokens), np.uint8))
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        keys, merged = [], []
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    merged.append(rank)
        order = np.argsort(keys)
        self.pair_key = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.pair_rank = np.append(np.array(merged, np.int64)[order], NO_RANK)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merged pair, which is the merged token's id too; NO_RANK where it is none."""
        key = left * self.size + right
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NO_RANK)


def merge_trees(vocabulary: Vocabulary, data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of byte strings, one after the other, and how many each has: rows of `data` filled up to one width, a power of two; all are of 2 bytes at least.

    Leaf p of a tree holds rank * width + p of the pair that begins at position p, so that the least value is
    the leftmost of the least ranks.
    """
    rows, width = data.shape
    part = vocabulary.byte_id[data]  # the id of the part that begins at a position
    place = np.arange(width)
    live = place < length[:, None]
    following = np.where(live, np.minimum(place + 1, length[:, None]), 0)  # the next part's position, or the end
    before = np.broadcast_to(place - 1, (rows, width)).copy()
    none = NO_RANK * width
    tree = np.full((rows, 2 * width), none, np.int64)
    rank = vocabulary.pair(part[:, :-1], part[:, 1:])
    good = (rank < NO_RANK) & live[:, 1:]
    tree[:, width : 2 * width - 1][good] = (rank * width + place[:-1])[good]
    level = width // 2
    while level:
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        level //= 2

    def update(row: np.ndarray, position: np.ndarray, value: np.ndarray) -> None:
        node = position + width
        tree[row, node] = value
        while width > 1 and node[0] > 1:
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    active = np.flatnonzero(tree[:, 1] < none)
    while len(active):
        best = tree[active, 1]
        left, merged = best % width, best // width
        right = following[active, left]
        after = following[active, right]
        part[active, left] = merged
        live[active, right] = False
        following[active, left] = after
        inner = after < length[active]
        before[active[inner], after[inner]] = left[inner]
        update(active, right, np.full(len(active), none))
        # The merged part with the live part after it ...
        value = np.full(len(active), none)
        rank = vocabulary.pair(merged[inner], part[active[inner], after[inner]])
        value[inner] = np.where(rank < NO_RANK, rank * width + left[inner], none)
        update(active, left, value)
        # ... and the live part before it with the merged part.
        has = before[active, left] >= 0
        if has.any():
            row, previous = active[has], before[active[has], left[has]]
            rank = vocabulary.pair(part[row, previous], merged[has])
            update(row, previous, np.where(rank < NO_RANK, rank * width + previous, none))
        active = active[tree[active, 1] < none]
    return part[live].astype(np.uint32), live.sum(axis=1)


class Ids:
    """Lists of ids by number, in two flat arrays."""

    def __init__(self, counts: np.ndarray | None = None, flat: np.ndarray | None = None):
        self.counts = np.zeros(0, np.int64) if counts is None else counts
        self.flat = np.zeros(0, np.uint32) if flat is None else flat
        self.ends = np.cumsum(self.counts)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbers `at`, one list after the other, and the lists' lengths."""
        n = self.counts[at]
        shift = self.ends[at] - np.cumsum(n)
        return self.flat[np.repeat(shift, n) + np.arange(int(n.sum()))], n

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        self.__init__(np.concatenate((self.counts, counts)), np.concatenate((self.flat, flat)))


def encode_pieces(vocabulary: Vocabulary, pieces: list[bytes]) -> Ids:
    """Ids of each piece; a piece that is a token as a whole is that token."""
    rank = vocabulary.rank.get
    whole = np.fromiter((rank(piece, -1) for piece in pieces), np.int64, len(pieces))
    length = np.fromiter(map(len, pieces), np.int64, len(pieces))
    rest = np.flatnonzero(whole < 0)
    order, flats, counts = [np.flatnonzero(whole >= 0)], [], []
    flats.append(whole[order[0]].astype(np.uint32))
    counts.append(np.ones(len(order[0]), np.int64))
    level = np.ceil(np.log2(np.maximum(length, 2))).astype(np.int64)
    for exponent in np.unique(level[rest]):
        members, width = rest[level[rest] == exponent], 1 << int(exponent)
        step = max(1, TREE_LEAVES // width)
        for k in range(0, len(members), step):
            group = members[k : k + step]
            data = np.frombuffer(b"".join([pieces[i].ljust(width, b"\0") for i in group]), np.uint8).reshape(-1, width)
            flat, count = merge_trees(vocabulary, data, length[group])
            order.append(group)
            flats.append(flat)
            counts.append(count)
    placed = np.empty(len(pieces), np.int64)
    placed[np.concatenate(order)] = np.arange(len(pieces))
    flat, count = Ids(np.concatenate(counts), np.concatenate(flats)).take(placed)
    return Ids(count, flat)


class Encoder:
    """Encodes batches of texts, remembering words between them.

    A text is first cut before each blank that a letter, digit or ASCII mark follows. The pattern cuts there in
    any case: a match that began before can only hold white space up to that blank, without it, and none looks
    back. So a word, with its blank and whatever white space ends it, has the same pieces wherever it stands.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.pieces = regex.compile(pattern).findall
        self.cut = re.compile(" (?=[!-~\u00c0-\u024f])").split
        self.reset()

    def reset(self) -> None:
        self.number: dict[str | tuple[str], int] = {}
        self.ids = Ids()

    def split(self, word: str) -> list[str]:
        """Pieces of " " + word; letters alone, and letters with one mark at the end, need no pattern."""
        if word.isalpha():
            return [" " + word]
        if word[-1:] in MARKS and word[:-1].isalpha():
            return [" " + word[:-1], word[-1]]
        return self.pieces(" " + word)

    def learn(self, new: list[str | tuple[str]]) -> None:
        """Words: " " + a string as such, or the string alone of a tuple, which begins a text."""
        found = [self.pieces(word[0]) if type(word) is tuple else self.split(word) for word in new]
        number: dict[str, int] = {}
        at = np.array([number.setdefault(piece, len(number)) for pieces in found for piece in pieces], np.int64)
        flat, n = encode_pieces(self.vocabulary, [piece.encode() for piece in number]).take(at)
        ends = np.concatenate(([0], np.cumsum(n)))[np.cumsum([len(pieces) for pieces in found])]
        first = len(self.number)
        self.number.update((word, first + i) for i, word in enumerate(new))
        self.ids.add(flat, np.diff(ends, prepend=0))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (unsigned 32-bit) of each text."""
        if not texts:
            return []
        if len(self.number) > CACHE_WORDS:
            self.reset()
        numbers, missing = [], []
        for text in texts:
            words = self.cut(text)
            words[0] = (words[0],)
            known = list(map(self.number.get, words))
            if None in known:
                missing.append((len(numbers), words))
            numbers.append(known)
        if missing:
            new = {word for i, words in missing for word, at in zip(words, numbers[i], strict=True) if at is None}
            self.learn(list(new))
            for i, words in missing:
                numbers[i] = list(map(self.number.__getitem__, words))
        flat, n = self.ids.take(np.fromiter(chain.from_iterable(numbers), np.int64))
        ends = np.concatenate(([0], np.cumsum(n)))[np.cumsum(list(map(len, numbers)))]
        return np.split(flat, ends[:-1])


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    return vocabulary.bytes.take(ids)[0].tobytes()


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder_for(ranks: bytes, pattern: str) -> Encoder:
    key = (hashlib.sha256(ranks).hexdigest(), pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(Vocabulary(ranks), pattern)
    return _encoders[key]


ENCODED = "doc_id long, n_tokens long, ids array<long>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _encoding(documents: DataFrame, ranks_path: str, pattern: str, digests: bool) -> DataFrame:
    with open(ranks_path, "rb") as file:
        ranks = file.read()
    shared = documents.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary's size, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(shared.value, pattern)
        for batch in slices(batches):
            encoded = encoder.encode(batch.column("text").to_pylist())
            decoded = [decode(encoder.vocabulary, ids) for ids in encoded]
            counts = pa.array([len(ids) for ids in encoded], pa.int64())
            if digests:
                columns = [
                    pa.array([hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids in encoded], pa.string()),
                    pa.array([hashlib.sha256(text).hexdigest() for text in decoded], pa.string()),
                ]
                names = ["ids_sha256", "decoded_sha256"]
            else:
                flat = np.concatenate([np.zeros(0, np.uint32), *encoded]).astype(np.int64)
                offsets = np.concatenate(([0], np.cumsum([len(ids) for ids in encoded]))).astype(np.int32)
                columns = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array([x.decode() for x in decoded], pa.string())]
                names = ["ids", "decoded"]
            yield pa.record_batch([batch.column("doc_id"), counts, *columns], names=["doc_id", "n_tokens", *names])

    return mapped(text_frame(documents), run, DIGESTS if digests else ENCODED)


def encode_documents(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from them, for every document.

    Null text counts as empty and has no ids. Special tokens are ordinary text. Repeated rows are encoded
    each; rows without a doc_id are left out; other columns are ignored; an empty table gives an empty one.
    """
    return _encoding(documents, ranks_path, pattern, digests=False)


def encoding_digests(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """As encode_documents, with SHA-256 of the ids (little-endian unsigned 32-bit) and of the decoded bytes."""
    return _encoding(documents, ranks_path, pattern, digests=True)
