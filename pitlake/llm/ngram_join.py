"""Jaccard join of documents on word n-grams: candidates from shared rare n-grams, each pair verified on its texts.

Sizes bound the candidates from the start. Every document's n-grams are put into one order, rare ones first,
and only its first columns enter: of n n-grams, so many that two documents of the wanted similarity must
share one. Within a column, rows meet in blocks of like size; pairs whose sizes, or whose positions in the order,
leave too little overlap are discarded; for the others the overlap is counted in full.

A column shared by m documents is not expanded into m * m pairs. Equal sets are one row first. Then each block of
a column meets its smallest member alone; the links found give components. Rows outside a column's main
component meet a few more of its members, drawn by hash, so that copies which the smallest member alone
doesn't reach join as well; and only pairs between components that are still different meet afterwards, those outside the
main component against all, and a pair that shares many columns only in its first ones. No link between components
is lost, and a large group of copies costs about as many pairs as it has members.

Components need some of the links only. All of them lie within components: for these, a component's distinct sets are dealt
into parts, each two parts meet in a tile, and there the overlaps of all their pairs are added up column by column.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_values, kept, mapped, mix, raw, slices, text_frame, white_space, words
from .components import components

WORDS = 5
PERCENT = 80
HEAVY = 1 << 17  # n-grams whose frequency orders columns: those in most documents; it moves costs, not results
HEAVY_FROM = 16  # documents
MARK_BITS = 31
BATCH_BYTES = 8 << 20  # texts in which equal sets and repeated n-grams are met before the shuffle
HASH_BYTES = 256 << 10  # texts whose words are hashed at once
TILE, TILE_BYTES = 256, 8 << 20  # documents and text in one part of a component
TILE_COLUMNS = 4096  # columns added up at once
LEADS = 6  # members of a column's main component that its other rows meet before all of the column; it moves costs, not results
EARLY = 4  # of a document's columns: pairs that share one of them don't meet in later columns; it moves costs, not results
BAND = 1.25  # sizes of documents in one block; 100 / PERCENT


def shingle_sets(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's n-grams; of fewer words, one hash of them all; of none, none."""
    return [found for part in slices([batch], limit=HASH_BYTES) for found in sets_of(part, n)]


def sets_of(batch: pa.RecordBatch, n: int) -> Iterator[np.ndarray]:
    data, offsets = raw(batch.column("text"))
    hashes, owner, _, _ = words(data, offsets, white_space(), byte_values(True))
    first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
    factor = np.uint64(0xD6E8FEB86659FD93)
    rolled = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for i in range(n):
        rolled = rolled * factor + hashes[i : i + len(rolled)]
    rolled = mix(rolled)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            yield distinct(rolled[a : b - n + 1])
        elif b > a:
            value = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                value = value * factor + h
            yield mix(value + np.uint64(n))
        else:
            yield rolled[:0].copy()


def distinct(values: np.ndarray) -> np.ndarray:
    """np.unique, which takes several times as long over the few values of one text."""
    values = np.sort(values)
    new = values[1:] != values[:-1]
    return values if new.all() else values[np.concatenate(([True], new))]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


KEYS = "doc_id long, size long, key1 long, key2 long, hash long, documents long"


def keys_and_counts(docs: DataFrame, n: int) -> DataFrame:
    """A row for each document: size and key of its set. And rows (hash, documents): n-grams in several documents of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=BATCH_BYTES):
            sets = shingle_sets(batch, n)
            found, times = np.unique(np.concatenate(sets), return_counts=True)
            found, times = found[times > 1], times[times > 1]
            key1, key2 = set_keys(sets)
            more, less = pa.nulls(len(found), pa.int64()), pa.nulls(len(sets), pa.int64())
            columns = [pa.concat_arrays([x, more]) for x in (batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(key1), pa.array(key2))]
            columns += [pa.concat_arrays([less, pa.array(x)]) for x in (found.view(np.int64), times.astype(np.int64))]
            yield pa.record_batch(columns, names=["doc_id", "size", "key1", "key2", "hash", "documents"])

    return mapped(docs, run, KEYS)


def set_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share."""
    key1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
    key2 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
    return key1.view(np.int64), key2.view(np.int64)


def incidence(docs: DataFrame, heavy, n: int, percent: int) -> DataFrame:
    """Entries of the matrix: column, doc_id, mark (the set's size and the column's place in the order; -1 - mark if the column is frequent).

    Only each document's first columns in the order (frequency, hash), and of equal sets in a batch only one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = heavy.value
        for batch in slices(batches, limit=BATCH_BYTES):
            sets = shingle_sets(batch, n)
            key1, key2 = set_keys(sets)
            seen, columns, docs, marks = set(), [], [], []
            for s, key, doc in zip(sets, zip(key1.tolist(), key2.tolist(), strict=True), batch.column("doc_id").to_numpy(), strict=True):
                if not len(s) or (len(s), key) in seen:
                    continue
                seen.add((len(s), key))
                weight = np.zeros(len(s), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    weight = np.where(known[at] == s, rank[at], 0)
                order = np.argsort(weight, kind="stable")[: prefix_length(len(s), percent)]
                columns.append(s[order])
                docs.append(np.full(len(order), doc))
                mark = (len(s) << MARK_BITS) + np.arange(len(order))
                marks.append(np.where(weight[order] > 0, -1 - mark, mark))
            if columns:
                yield pa.record_batch(
                    [pa.array(np.concatenate(columns).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (docs, marks))],
                    names=["column", "doc_id", "mark"],
                )

    return mapped(docs, run, "column long, doc_id long, mark long")


def shared_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by column, band, row: those of columns with two rows at least, with the first row of their band.

    Entries of frequent columns (place is -1 - place), of which other tasks have some too, pass with no hub.
    """
    names = ["column", "band", "doc_id", "size", "place", "hub", "hub_size", "hub_place"]
    waiting = None  # the first entry of the last column, so far alone
    lead = None  # (column, band, doc, size, place) of the first of the last band
    for batch in batches:
        entries = [batch.column(c).to_numpy() for c in names[:5]]
        hot = entries[4] < 0
        if hot.any():
            *frequent, place = (x[hot] for x in entries)
            yield pa.record_batch([*(pa.array(x) for x in (*frequent, -1 - place)), *(pa.nulls(len(place), pa.int64()) for _ in range(3))], names=names)
            entries = [x[~hot] for x in entries]
        column, band, doc, size, place = entries
        if not len(column):
            continue
        new = np.concatenate(([lead is None or column[0] != lead[0]], column[1:] != column[:-1]))
        follows = np.concatenate((~new[1:], [False]))
        keep = ~new | follows
        new_band = new | np.concatenate(([lead is None or band[0] != lead[1]], band[1:] != band[:-1]))
        starts = np.flatnonzero(new_band)
        at = np.searchsorted(starts, np.arange(len(column)), "right") - 1
        hub = np.where(at >= 0, starts[np.maximum(at, 0)] if len(starts) else 0, -1)
        out = [column, band, doc, size, place]
        hubs = [np.where(hub >= 0, x[hub], y) for x, y in zip((doc, size, place), lead[2:] if lead else (0, 0, 0), strict=True)]
        rows = [x[keep] for x in (*out, *hubs)]
        if waiting is not None and not new[0]:
            rows = [np.concatenate(([w], r)) for w, r in zip((*waiting, *waiting[2:]), rows, strict=True)]
        alone = np.flatnonzero(new)
        last = int(alone[-1]) if len(alone) else None
        if last == len(column) - 1:
            waiting = tuple(int(x[-1]) for x in out)
        else:
            waiting = None
        begin = int(starts[-1]) if len(starts) else None
        if begin is not None:
            lead = tuple(int(x[begin]) for x in out)
        if len(rows[0]):
            yield pa.record_batch([pa.array(r.astype(np.int64)) for r in rows], names=names)


ENTRY = "column long, band long, doc_id long, size long, place long, hub long, hub_size long, hub_place long"


def enough(a: str, b: str, percent: int):
    """The sizes, and what is left behind the places of a shared column, allow the similarity."""
    sizes = f"100 * least({a}size, {b}size) >= {percent} * greatest({a}size, {b}size)"
    left = f"(1 + least({a}size - {a}place, {b}size - {b}place) - 1)"
    return F.expr(f"{sizes} and {100 + percent} * {left} >= {percent} * ({a}size + {b}size)")


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, before they are shuffled."""
    codec = pa.Codec("zstd", 3)
    for batch in slices(batches):
        texts = [text.as_buffer() for text in batch.column("text").cast(pa.binary())]
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary()), pa.array([t.size for t in texts], pa.int64())],
            names=["doc_id", "body", "bytes"],
        )


def verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full overlap reaches the similarity.

    Each a is a block: its own text comes first, then those it is paired with. Texts are moved compressed; their
    sets, which are several times larger, are made where they are compared.
    """
    pairs = kept(pairs)
    needed = pairs.select(F.col("a").alias("block"), F.col("b").alias("doc_id")).union(pairs.select("a", "a").distinct())
    # The pairs' documents grow with the corpus, so they aren't broadcast, however few they look.
    rows = mapped(docs, packed, "doc_id long, body binary, bytes long").hint("merge").join(needed, "doc_id")
    rows = rows.withColumn("other", F.col("doc_id") != F.col("block")).repartition("block").sortWithinPartitions("block", "other")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, block, own = pa.Codec("zstd"), None, None
        for whole in batches:
            for batch in slices([whole], "body", 2 << 20):
                bodies = zip(batch.column("body"), batch.column("bytes").to_pylist(), strict=True)
                texts = pa.array([codec.decompress(x.as_buffer(), size, asbytes=True) for x, size in bodies], pa.large_binary())
                sets = shingle_sets(pa.record_batch([texts], names=["text"]), n)
                out: tuple[list, list] = ([], [])
                for a, b, s in zip(batch.column("block").to_pylist(), batch.column("doc_id").to_pylist(), sets, strict=True):
                    if a != block or a == b:
                        block, own = a, s
                        continue
                    common = len(np.intersect1d(own, s, assume_unique=True))
                    if 100 * common >= percent * (len(own) + len(s) - common):
                        out[0].append(a)
                        out[1].append(b)
                yield pa.record_batch([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

    return kept(mapped(rows, count, "a long, b long"))


def jaccard_groups(documents: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document.

    Two documents link when their sets of n-grams of lower-cased (A-Z) words have a Jaccard similarity
    of percent / 100 or more; component_id is the smallest doc_id that links reach.

    Null and empty texts have no n-grams and link with nothing; a text of under n words is one n-gram. A
    repeated doc_id gets a row for each of its rows; a link of any of its texts is its link. Rows without a
    doc_id are left out, other columns ignored; an empty table gives an empty one. n-grams are compared by
    64-bit hashes.
    """
    _, rows, rep_of, label = connected(documents, n, percent)
    return with_components(rows, rep_of, label, None)


def jaccard_join(documents: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """jaccard_groups with n_links: how many other sets, each known by its smallest document, link with the document's.

    Every link is verified and counted; copies of one set aren't expanded into pairs.
    """
    docs, rows, rep_of, label = connected(documents, n, percent)
    degree = tiled(docs, label, n, percent, True).groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    return with_components(rows, rep_of, label, degree)


def jaccard_links(documents: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """a, b: every link between distinct sets, each known by its smallest document, the smaller first."""
    docs, _, _, label = connected(documents, n, percent)
    return tiled(docs, label, n, percent, False)


def with_components(rows: DataFrame, rep_of: DataFrame, label: DataFrame, degree: DataFrame | None) -> DataFrame:
    none = F.lit(0).cast("long")
    of_class = rep_of.join(label.withColumnRenamed("node", "rep"), "rep", "left")
    of_class = of_class.withColumn("n_links", none) if degree is None else of_class.join(degree, "rep", "left")
    grouped = of_class.groupBy("doc_id").agg(F.min(F.coalesce("label", "rep")).alias("component"), F.max("n_links").alias("links"))
    found = rows.join(grouped, "doc_id", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("links", none).alias("n_links"),
    )
    return found.drop("n_links") if degree is None else found


def tile_links(ids: np.ndarray, part: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) between documents of the tile's two parts, or within its only one; sorted by part."""
    sizes = np.array([len(s) for s in sets])
    cut = int(np.searchsorted(part, part[0], "right"))
    left, right = (slice(0, cut), slice(cut, None)) if cut < len(ids) else (slice(None), slice(None))
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = times > 1
    place = np.cumsum(shared) - 1
    row, column = row[shared[column]], place[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(ids[left]), len(ids[right])), np.int64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, TILE_COLUMNS):
        a, b = np.searchsorted(column, (low, low + TILE_COLUMNS))
        matrix = np.zeros((len(sets), min(TILE_COLUMNS, int(column[-1]) + 1 - low)), np.float32)
        matrix[row[a:b], column[a:b] - low] = 1
        common += (matrix[left] @ matrix[right].T).astype(np.int64)
    total = sizes[left][:, None] + sizes[right][None, :] - common
    links = (100 * common >= percent * total) & (common < total)  # equal sets are one, whatever texts a repeated doc_id has
    if left == right:
        links = np.triu(links, 1)
    x, y = np.nonzero(links)
    x, y = ids[left][x], ids[right][y]
    a, b = np.minimum(x, y)[x != y], np.maximum(x, y)[x != y]
    if len(np.unique(ids)) < len(ids) and len(a):
        a, b = np.unique(np.stack((a, b)), axis=1)
    return a, b


def tiled(docs: DataFrame, label: DataFrame, n: int, percent: int, count: bool) -> DataFrame:
    """All links (a, b) of the labelled documents, or with `count` rows (rep, n_links) to be added up.

    The documents of a component are dealt by hash into parts; each two parts are a tile, so that a large component is
    many tasks' work and a text moves once for each part, not for each pair.
    """
    node = label.withColumnRenamed("node", "doc_id")
    of_text = docs.select("doc_id", F.octet_length("text").alias("bytes")).join(node, "doc_id")
    parts = F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("bytes") / TILE_BYTES), F.lit(1)).cast("int")
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    needed = node.join(of_text.groupBy("label").agg(parts.alias("parts")), "label").withColumn("part", part)
    needed = needed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    needed = needed.select("doc_id", "label", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    rows = mapped(docs, packed, "doc_id long, body binary, bytes long").hint("merge").join(needed, "doc_id")
    rows = rows.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "part", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, tile, ids, part, sets = pa.Codec("zstd"), None, [], [], []

        def finished() -> pa.RecordBatch:
            a, b = tile_links(np.array(ids, np.int64), np.array(part), sets, percent) if len(ids) > 1 else ([], [])
            if count:
                a, b = np.unique(np.concatenate((a, b)).astype(np.int64), return_counts=True)
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["rep", "n_links"] if count else ["a", "b"])

        for whole in batches:
            for batch in slices([whole], "body", 2 << 20):
                bodies = zip(batch.column("body"), batch.column("bytes").to_pylist(), strict=True)
                texts = pa.array([codec.decompress(x.as_buffer(), size, asbytes=True) for x, size in bodies], pa.large_binary())
                made = shingle_sets(pa.record_batch([texts], names=["text"]), n)
                for *key, doc, p, own in zip(*(batch.column(c).to_pylist() for c in ("label", "i", "j", "doc_id", "part")), made, strict=True):
                    if key != tile:
                        yield finished()
                        tile, ids, part, sets = key, [], [], []
                    ids.append(doc)
                    part.append(p)
                    sets.append(own)
        yield finished()

    return mapped(rows, run, "rep long, n_links long" if count else "a long, b long")


def connected(documents: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The texts; a row for each document with its set's size; doc_id and rep, the smallest document of its set; node and label of every linked rep."""
    if not 50 < percent <= 100 or n < 1:
        raise ValueError("percent is over 50 and at most 100, n is 1 or more")
    spark = documents.sparkSession
    docs = text_frame(documents)
    first_pass = kept(keys_and_counts(docs, n))
    rows = first_pass.where("doc_id is not null").select("doc_id", "size", "key1", "key2")
    counts = first_pass.where("doc_id is null").groupBy("hash").agg(F.sum("documents").alias("documents"))
    top = counts.where(F.col("documents") >= HEAVY_FROM).orderBy(F.desc("documents"), "hash").limit(HEAVY).toPandas()
    known = top["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    heavy = spark.sparkContext.broadcast((known[order], top["documents"].to_numpy(np.int64)[order]))
    # Each distinct set is known by its smallest document.
    classes = rows.where("size > 0").groupBy("size", "key1", "key2").agg(F.min("doc_id").alias("rep"))
    rep_of = kept(rows.join(classes, ["size", "key1", "key2"]).select("doc_id", "rep").distinct())
    entries = incidence(docs, heavy, n, percent)
    mark = "if(mark < 0, -1 - mark, mark)"
    size = F.expr(f"shiftright({mark}, {MARK_BITS})")
    place = F.expr(f"{mark} & {(1 << MARK_BITS) - 1}")
    band = F.floor(F.log(size) / math.log(BAND)).cast("long")
    # Columns in few documents: sorted and read once. Frequent ones are dealt by row, then aggregates and a join, which can be split.
    dealt = entries.repartition(F.when(F.col("mark") < 0, F.xxhash64("column", "doc_id")).otherwise(F.col("column")))
    dealt = dealt.select("column", band.alias("band"), "doc_id", size.alias("size"), F.when(F.col("mark") < 0, -1 - place).otherwise(place).alias("place"))
    read = kept(mapped(dealt.sortWithinPartitions("column", "band", "doc_id"), shared_entries, ENTRY))
    hot = read.where("hub is null").select("column", "band", "doc_id", "size", "place")
    hubs = hot.groupBy("column", "band").agg(F.min(F.struct("doc_id", "size", "place")).alias("lead"))
    many = hot.groupBy("column").agg(F.count("*").alias("rows")).where("rows > 1").select("column")
    warm = (
        hot.join(hubs, ["column", "band"])
        .join(many, "column")
        .select(*hot.columns, F.col("lead.doc_id").alias("hub"), F.col("lead.size").alias("hub_size"), F.col("lead.place").alias("hub_place"))
    )
    shared = read.where("hub is not null").unionByName(kept(warm))
    star = shared.where("hub <> doc_id").where(enough("", "hub_", percent)).select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    first = verified(of_reps(star, rep_of), docs, n, percent)
    split = divided(shared.select("column", "band", "doc_id", "size", "place"), first, rep_of)
    wide = split.where(F.col("members") > LEADS)  # in the others, all of the column is as little
    leads = wide.where("label = main").groupBy("column", "band").agg(
        *(F.min(F.struct(F.xxhash64("doc_id", F.lit(i)).alias("draw"), "doc_id", "size", "place")).alias(f"lead{i}") for i in range(LEADS))
    )
    leads = leads.select("column", "band", F.inline(F.array(*(f"lead{i}" for i in range(LEADS))))).drop("draw").distinct()
    met = outside(wide).join(leads, ["column", "band"]).where(enough("x_", "", percent))
    met = met.select(F.col("x_doc_id").alias("a"), F.col("doc_id").alias("b"))
    links = first.unionByName(verified(of_reps(met, rep_of), docs, n, percent))
    # Components only grow, so a column that is of one stays so.
    split = with_early(divided(split.drop("label", "main", "members"), links, rep_of))
    second_pairs = (
        outside(split).join(split, ["column", "band"])
        .where("x_label <> label and (label = main or x_doc_id < doc_id)")
        .where(enough("x_", "", percent)).where("not arrays_overlap(x_early, early)")
        .select(F.col("x_doc_id").alias("a"), F.col("doc_id").alias("b"))
    )
    links = links.unionByName(verified(of_reps(second_pairs, rep_of), docs, n, percent))
    return docs, rows, rep_of, components(links)


def divided(rows: DataFrame, links: DataFrame, rep_of: DataFrame) -> DataFrame:
    """The rows of columns that hold several components, each with its component, the one of most rows (main) and the column's rows (members)."""
    label = components(links).withColumnRenamed("node", "rep")
    label = rep_of.join(label, "rep", "left").select("doc_id", F.coalesce("label", "rep").alias("label"))
    placed = kept(rows.join(label, "doc_id"))
    main = (
        placed.groupBy("column", "label").agg(F.count("*").alias("rows"))
        .groupBy("column").agg(F.max_by("label", F.struct("rows", "label")).alias("main"), F.count("*").alias("labels"), F.sum("rows").alias("members"))
        .where("labels > 1").select("column", "main", "members")
    )
    return kept(placed.join(main, "column"))


def with_early(split: DataFrame) -> DataFrame:
    """The rows with those of their document's first EARLY columns that come before their own.

    Two documents of different components that share a column meet in it. If they share an earlier one too, they meet
    there: its places are as small or smaller, so no less overlap is left.
    """
    own = Window.partitionBy("doc_id", "size").orderBy("place", "column")
    first = F.when(F.row_number().over(own) <= EARLY, F.col("column"))
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    return split.withColumn("first", first).withColumn("early", F.collect_list("first").over(before)).drop("first")


def outside(split: DataFrame) -> DataFrame:
    """The rows outside their column's main component, once for each band in which they can have a partner."""
    return split.where("label <> main").select(
        "column", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
        *(F.col(c).alias(f"x_{c}") for c in split.columns if c not in ("column", "band", "main", "members")),
    )


def of_reps(pairs: DataFrame, rep_of: DataFrame) -> DataFrame:
    """Distinct pairs of the sets' representatives, the smaller first."""
    pairs = pairs.distinct().join(rep_of.select(F.col("doc_id").alias("a"), F.col("rep").alias("x")), "a")
    pairs = pairs.join(rep_of.select(F.col("doc_id").alias("b"), F.col("rep").alias("y")), "b").where("x <> y")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
