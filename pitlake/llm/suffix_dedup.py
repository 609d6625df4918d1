"""Repeated passages by a depth-limited radix sort of suffixes.

Two equal strings of `window` bytes hold, at the same offset, the same least-hashed `gram`: so only suffixes
at such anchors need sorting, about one in sixteen, each with the bytes that a window around it can
take. Passes go by most significant digit, and what stands alone after a pass leaves: first the gram itself, as
a shuffle of hashes; then, for the anchors left, gram and bytes around it as a range of sorted rows; then, where one gram
has different surroundings, eight-byte digits of each of its windows in turn. Groups left after the
last digit are exactly the repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_values, kept, mapped, mix, powers, prefix_sums, raw, slices, text_frame, union

WINDOW = 50
GRAM = 20
REACH = WINDOW - GRAM  # bytes on either side of a gram that a window holding it can take
SIDE = 1 << 20  # bytes hashed at once
GROUP_ROWS = 50_000  # different surroundings of grams refined at once; a gram with more goes by shuffled windows


def sliding(function, x: np.ndarray, width: int) -> np.ndarray:
    """function over every run of `width` values; one result per start."""
    done = 1
    while done * 2 <= width:
        x = function(x[: len(x) - done], x[done:])
        done *= 2
    rest = width - done
    return function(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position in data, value's index, 48-bit hash) of every gram that is the least in some window inside one value."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none, none, none
    sums = prefix_sums(data, byte_values(False))
    _, down = powers(len(data) + 1)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1]) | np.uint64(1)
    width = REACH + 1
    least = sliding(np.minimum, grams, width)  # by the window's start
    start = np.arange(len(least))
    ends = offsets[np.searchsorted(offsets, start, "right")]
    least[start + WINDOW > ends] = 0
    padded = np.concatenate((np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)))
    position = np.flatnonzero(grams == sliding(np.maximum, padded, width))
    return position, np.searchsorted(offsets, position, "right") - 1, (grams[position] >> np.uint64(16)).astype(np.int64)


def emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=SIDE):
        data, offsets = raw(batch.column("text"))
        _, row, gram = anchors(data, offsets)
        doc = batch.column("doc_id").to_numpy()[row]
        order = np.lexsort((gram, row))
        row, gram, doc = row[order], gram[order], doc[order]
        once = np.concatenate(([True], (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])))[: len(row)]
        yield pa.record_batch([pa.array(gram[once]), pa.array(doc[once])], names=["gram", "doc_id"])


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram: those whose gram has another row."""
    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, doc = batch.column("gram").to_numpy(), batch.column("doc_id").to_numpy()
        before = None if waiting is None else waiting[0]
        same = np.concatenate(([gram[0] == before], gram[1:] == gram[:-1]))
        keep = same | np.concatenate((same[1:], [False]))
        out = [gram[keep], doc[keep]]
        if waiting is not None and same[0] and not waiting[2]:
            out = [np.concatenate(([w], x)) for w, x in zip(waiting, out)]
        waiting = (int(gram[-1]), int(doc[-1]), bool(keep[-1]))
        if len(out[0]):
            yield pa.record_batch([pa.array(x) for x in out], names=["gram", "doc_id"])


def emit_surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text and its list of repeated grams: gram, place, bytes before it, gram and bytes around."""
    for batch in slices(batches, limit=SIDE):
        data, offsets = raw(batch.column("text"))
        position, row, gram = anchors(data, offsets)
        wanted = batch.column("grams")
        flat, cut = wanted.values.to_numpy(), np.asarray(wanted.offsets)
        keep = np.zeros(len(position), np.bool_)
        first = np.searchsorted(row, np.arange(batch.num_rows + 1))
        for i in range(batch.num_rows):
            a, b = first[i], first[i + 1]
            keep[a:b] = np.isin(gram[a:b], flat[cut[i] : cut[i + 1]])
        position, row, gram = position[keep], row[keep], gram[keep]
        low, high = np.maximum(position - REACH, offsets[row]), np.minimum(position + WINDOW, offsets[row + 1])
        length = high - low
        ends = np.cumsum(length)
        around = data[np.repeat(low - ends + length, length) + np.arange(int(ends[-1]) if len(ends) else 0)]
        yield pa.record_batch(
            [
                pa.array(gram),
                batch.column("doc_id").take(pa.array(row)),
                pa.array(position - offsets[row]),
                pa.array((position - low).astype(np.int32)),
                pa.Array.from_buffers(pa.binary(), len(gram), [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(around)]),
            ],
            names=["gram", "doc_id", "place", "before", "around"],
        )


SURROUNDINGS = "gram long, doc_id long, place long, before int, around binary"
FOUND = "doc_id long, start long, end long, gram long, before int, around binary"


def fields(rows: list[np.ndarray], left: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Windows covered: True at (row, offset) if an equal window at the same offset is in a smaller document.

    rows: group, doc, bytes before and after the gram; matrix: the bytes, gram at column REACH.
    """
    group, doc, after = rows
    covered = np.zeros((len(group), REACH + 1), np.bool_)
    for offset in range(REACH + 1):
        live = np.flatnonzero((offset >= REACH - left) & (offset <= after))
        label = group[live]
        around = np.concatenate((matrix[live, offset:REACH], matrix[live, WINDOW : WINDOW + offset]), axis=1)
        digits = np.zeros((len(live), -(-REACH // 8) * 8), np.uint8)
        digits[:, :REACH] = around
        digits = digits.view(">u8")
        for i in range(digits.shape[1]):
            if not len(live):
                break
            order = np.lexsort((digits[:, i], label))
            live, digits, label = live[order], digits[order], label[order]
            new = np.concatenate(([True], (label[1:] != label[:-1]) | (digits[1:, i] != digits[:-1, i])))
            label = np.cumsum(new)
            alone = new & np.concatenate((new[1:], [True]))
            live, digits, label = live[~alone], digits[~alone], label[~alone]
        if len(live):
            starts = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
            smallest = np.minimum.reduceat(doc[live], starts)
            covered[live, offset] = doc[live] > np.repeat(smallest, np.diff(np.append(starts, len(live))))
    return covered


def refine(gram: list, doc: list, place: list, left: list, around: list, until: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of covered stretches, of grams with several surroundings; each row stands at places from place until `until`."""
    gram, doc, place, left, until = (np.array(x, np.int64) for x in (gram, doc, place, left, until))
    matrix = np.zeros((len(gram), WINDOW + REACH), np.uint8)
    length = np.array([len(x) for x in around], np.int64)
    column = np.repeat(REACH - left, length) + np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    matrix[np.repeat(np.arange(len(gram)), length), column] = np.frombuffer(b"".join(around), np.uint8)
    # Hashes of grams may collide: their bytes are the first part of the group.
    _, group = np.unique(np.column_stack((gram.view(np.uint8).reshape(-1, 8), matrix[:, REACH:WINDOW])).copy().view(f"V{8 + GRAM}").ravel(), return_inverse=True)
    covered = fields([group.ravel(), doc, length - left - GRAM], left, matrix)
    edge = np.diff(np.pad(covered, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    return doc[row], place[row] - REACH + first, until[row] - REACH + last - 1 + WINDOW


def scan_surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram, surroundings, doc and place: covered stretches.

    Rows equal in all to one of a smaller document are covered as far as the bytes reach. Of the others, those
    that share a gram are held together and refined; past GROUP_ROWS of one gram they are passed on instead.
    Equal rows of the smallest document itself are one as long as they follow within WINDOW bytes: what is covered
    at each of the places then joins to one stretch.
    """
    block: list[list] = [[], [], [], [], [], []]  # of finished grams
    own: list[list] = [[], [], [], [], [], []]  # of the gram being read; the last list has the row's last place
    last, passing = None, False
    smallest = 0

    def stretches(doc, start, end) -> pa.RecordBatch:
        n = len(doc)
        return pa.record_batch(
            [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
            names=["doc_id", "start", "end", "gram", "before", "around"],
        )

    def passed(rows: list[list]) -> pa.RecordBatch:
        gram, doc, place, left, around, until = rows
        return pa.record_batch(
            [pa.array(doc, pa.int64()), pa.array(place, pa.int64()), pa.array(until, pa.int64()), pa.array(gram, pa.int64()), pa.array(left, pa.int32()), pa.array(around, pa.binary())],
            names=["doc_id", "start", "end", "gram", "before", "around"],
        )

    def several() -> bool:
        """The gram being read has several surroundings; the last row read is of the last."""
        return bool(own[0]) and (own[3][0], own[4][0]) != last[1:]

    for batch in batches:
        done: list[list] = [[], [], []]
        for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "doc_id", "place", "before", "around")), strict=True):
            gram, doc, place, left, around = row
            key = (gram, left, around)
            if key == last and doc > smallest:
                if len(around) >= WINDOW:
                    done[0].append(doc)
                    done[1].append(place - left)
                    done[2].append(place - left + len(around))
                continue
            if key == last and own[0] and place - own[5][-1] <= WINDOW:
                own[5][-1] = place
                continue
            if last is None or gram != last[0]:
                if passing:
                    yield passed(own)
                elif several():
                    for x, y in zip(block, own, strict=True):
                        x.extend(y)
                own, passing = [[], [], [], [], [], []], False
                if len(block[0]) >= GROUP_ROWS:
                    yield stretches(*refine(*block))
                    block = [[], [], [], [], [], []]
            for x, y in zip(own, (*row, place), strict=True):
                x.append(y)
            if len(own[0]) >= GROUP_ROWS:
                yield passed(own)
                own, passing = [[], [], [], [], [], []], True
            last, smallest = key, doc
        if done[0]:
            yield stretches(*done)
    if passing:
        yield passed(own)
    elif several():
        for x, y in zip(block, own, strict=True):
            x.extend(y)
    if block[0]:
        yield stretches(*refine(*block))


def emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for doc, place, until, gram, left, around in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "end", "gram", "before", "around")), strict=True):
            for at in range(len(around) - WINDOW + 1):
                for x, y in zip(out, (gram, at - left, around[at : at + WINDOW], doc, place - left + at, until - left + at + WINDOW), strict=True):
                    x.append(y)
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["gram", "shift", "window", "doc_id", "start", "end"])


def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out: list[list] = [[], [], [], [], []]
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found"), strict=True):
            text = text.encode()
            spans = np.zeros((0, 2), np.int64)
            if found.is_valid and len(found):
                flat = found.values
                spans = union(np.column_stack((flat.field("start").to_numpy(), flat.field("end").to_numpy())))
                spans = np.minimum(spans, len(text))
                spans = spans[spans[:, 1] > spans[:, 0]]
            at, rest = 0, []
            for a, b in spans.tolist():
                rest.append(text[at:a])
                at = b
            rest.append(text[at:])
            rest = b"".join(rest)
            values = (len(text), len(text) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), [{"start": a, "end": b} for a, b in spans.tolist()])
            for x, y in zip(out, values, strict=True):
                x.append(y)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"


def repeated_spans(documents: DataFrame) -> DataFrame:
    """doc_id, start, end: bytes of a document covered by strings of WINDOW bytes that also start in a smaller doc_id."""
    docs = text_frame(documents)
    # A whole text that a smaller document holds is covered; it adds no source that the smaller one isn't.
    hashed = docs.where(F.octet_length("text") >= WINDOW).select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.octet_length("text").cast("long").alias("end"))
    smallest = hashed.groupBy("digest").agg(F.min("doc_id").alias("first"))
    copies = kept(hashed.join(smallest, "digest").where("doc_id > first").select("doc_id", F.lit(0).cast("long").alias("start"), "end"))
    grams = mapped(docs, emit_anchors, "gram long, doc_id long").repartition("gram").sortWithinPartitions("gram")
    candidates = mapped(grams, repeated, "gram long, doc_id long").join(copies.select("doc_id"), "doc_id", "left_anti")
    lists = kept(candidates.groupBy("doc_id").agg(F.collect_list("gram").alias("grams")))
    around = mapped(docs.join(lists, "doc_id"), emit_surroundings, SURROUNDINGS)
    ordered = around.repartition("gram").sortWithinPartitions("gram", "before", "around", "doc_id", "place")
    found = kept(mapped(ordered, scan_surroundings, FOUND))
    # Grams with very many surroundings: their windows as rows, minima before the shuffle, joins that can be split.
    windows = mapped(found.where("around is not null"), emit_windows, "gram long, shift long, window binary, doc_id long, start long, end long")
    key = ["gram", "shift", "window"]
    least = windows.groupBy(*key).agg(F.min("doc_id").alias("least"))
    many = windows.join(least, key).where("doc_id > least").select("doc_id", "start", "end")
    return copies.unionByName(found.where("around is null").select("doc_id", "start", "end")).unionByName(many)


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte spans of every document.

    Every byte goes that is covered by a string of 50 bytes which also starts in a document with a smaller
    doc_id; strings are judged on the input. Null and empty texts have no bytes. Texts of under 50 bytes
    lose nothing. Where a doc_id is repeated, spans found for any of its rows hold for each. Rows without a
    doc_id are left out, other columns ignored; an empty table gives an empty one.
    """
    docs = text_frame(documents)
    spans = repeated_spans(documents).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    return mapped(docs.join(spans, "doc_id", "left").select("doc_id", "text", "found"), finish, RESULT)
