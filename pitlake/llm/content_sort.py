"""Exact duplicates by sorting content.

Texts equal within an input batch are merged first, so a hot text reaches its sort partition once per
batch, not once per copy. What is left is range-partitioned by the normalised text's first bytes and, where many
texts begin alike, their digest (Spark samples the splitters, which so stay small), sorted outside memory within
each partition, and neighbours are compared in full.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, mapped, slices, text_frame

SPLITTER_BYTES = 32
PARTIAL = "norm binary, digest binary, smallest long, largest long, copies long"


def merge_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of a batch."""
    for batch in slices(batches, "norm", 32 << 20):
        seen: dict[bytes, list] = {}
        for norm, doc_id in zip(batch.column("norm").to_pylist(), batch.column("doc_id").to_pylist(), strict=True):
            if norm in seen:
                entry = seen[norm]
                entry[0], entry[1], entry[2] = min(entry[0], doc_id), max(entry[1], doc_id), entry[2] + 1
            else:
                seen[norm] = [doc_id, doc_id, 1]
        norms = list(seen)
        yield pa.record_batch(
            [
                pa.array(norms, pa.binary()),
                pa.array([hashlib.sha256(x).digest() for x in norms], pa.binary()),
                *(pa.array([x[i] for x in seen.values()], pa.int64()) for i in range(3)),
            ],
            names=["norm", "digest", "smallest", "largest", "copies"],
        )


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows: each run of equal texts becomes one row. Only the text before is held."""
    names = ["digest", "smallest", "largest", "copies"]
    before, run = None, None

    def out(rows: list) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    for batch in slices(batches, "norm", 32 << 20):
        done = []
        for norm, digest, smallest, largest, copies in zip(*(batch.column(c).to_pylist() for c in ["norm", *names]), strict=True):
            if run is not None and norm == before:
                run[1], run[2], run[3] = min(run[1], smallest), max(run[2], largest), run[3] + copies
            else:
                if run is not None:
                    done.append(run)
                before, run = norm, [digest, smallest, largest, copies]
        if done:
            yield out(done)
    if run is not None:
        yield out([run])


def groups_of_equal_texts(documents: DataFrame, partitions: int | None = None) -> DataFrame:
    """A row per distinct normalised text: digest (SHA-256), smallest and largest doc_id, copies."""
    normalised = text_frame(documents).select("doc_id", lower_ascii("text").cast("binary").alias("norm"))
    partial = mapped(normalised, merge_batch, PARTIAL)
    by = (F.substring("norm", 1, SPLITTER_BYTES), F.col("digest"))
    # Without a count, Spark takes its shuffle partitions and merges small ones at run time.
    dealt = partial.repartitionByRange(partitions, *by) if partitions else partial.repartitionByRange(*by)
    ordered = dealt.sortWithinPartitions(*by, "norm")
    return mapped(ordered, neighbours, "digest binary, smallest long, largest long, copies long")


def exact_duplicates(documents: DataFrame, keep: str = "smallest", partitions: int | None = None) -> DataFrame:
    """Every document with its group of equal texts; equal after lower-casing A-Z alone.

    keep: the "smallest" or "largest" doc_id of a group stays. Null text counts as empty, and empty texts
    are a group like any other; a repeated doc_id with the same text is counted as often as it stands
    there. Rows without a doc_id are left out, other columns of the input are ignored; an empty table gives
    an empty one.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    groups = groups_of_equal_texts(documents, partitions).select(
        "digest", F.col(keep).alias("keep_id"), F.col("copies").alias("group_size")
    )
    ids = text_frame(documents).select("doc_id", F.unhex(F.sha2(lower_ascii("text").cast("binary"), 256)).alias("digest"))
    # A hot text is one row on the right, so adaptive execution can split its left side.
    return ids.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
