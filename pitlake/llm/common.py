"""What the operators share: tables kept in the shared folder, Arrow batches as byte arrays, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 1 << 20  # bytes hashed at once
MULTIPLIER = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffles go when the query that made them ends


def table(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; on one machine, where none is named, one below the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = spark.conf.get("spark.sql.warehouse.dir")
    return f"{named.rstrip('/')}/stage-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: cuts the lineage, outlives any executor.

    Nothing reads the shuffles of the write again, so they leave the disks with it, not when the driver next collects garbage.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FREED, before)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(column):
    return F.translate(column, UPPER, LOWER)


def text_frame(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone, null text as empty, whatever else the table holds; rows without a key are left out."""
    return df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each take about `limit` bytes at most, or are one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = raw(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a string or binary column, one after the other, and n + 1 offsets. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    if column.type != large:
        column = column.cast(large)
    if column.null_count:
        column = pc.fill_null(column, pa.scalar(b"" if large == pa.large_binary() else "", large))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    first = int(offsets[0]) if len(offsets) else 0
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[first : int(offsets[-1])] if len(offsets) else data[:0], offsets - first


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit of the input moves every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_values(fold: bool) -> np.ndarray:
    """A fixed random 64-bit number for each byte; with `fold`, A-Z have those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))
    if fold:
        values[65:91] = values[97:123]
    return values


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers 0 to n - 1 modulo 2**64, and their inverses."""
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK + 4096)
        for name, base in (("up", MULTIPLIER), ("down", pow(MULTIPLIER, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.cumprod(factors, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def prefix_sums(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums s so that (s[j] - s[i]) * down[i] is a hash of data[i:j]."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values.take(data) * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return sums


def blocks(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of about BLOCK bytes at ends of values or, in a long value, before a separator: no word is cut."""
    at, end = 0, int(offsets[-1])
    while at < end:
        to = min(at + BLOCK, end)
        if to < end:
            row = int(np.searchsorted(offsets, to, "right")) - 1
            if offsets[row] > at:
                to = int(offsets[row])
            else:  # inside a value that is longer than a block
                stop, look = int(offsets[row + 1]), to
                while look < stop:
                    found = np.flatnonzero(separator[data[look : look + BLOCK]])
                    if len(found):
                        look += int(found[0])
                        break
                    look += BLOCK
                to = min(look, stop)
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, value's index, start, end) of every run of bytes that aren't separators, in order; runs end with their value."""
    hashes, starts, ends = [], [], []
    edge = offsets[1:-1]
    for lo, hi in blocks(data, offsets, separator):
        part = data[lo:hi]
        inside = np.zeros(hi - lo + 2, np.bool_)
        np.logical_not(separator.take(part), out=inside[1:-1])
        step = inside[1:] != inside[:-1]
        cuts = edge[np.searchsorted(edge, lo, "right") : np.searchsorted(edge, hi, "left")] - lo
        cuts = np.unique(cuts[inside[cuts] & inside[cuts + 1]]) if len(cuts) else cuts
        bounds = np.flatnonzero(step)
        if len(cuts):
            bounds = np.sort(np.concatenate((bounds, cuts, cuts)))
        start, stop = bounds[0::2], bounds[1::2]
        sums = prefix_sums(part, values)
        _, down = powers(len(part) + 1)
        hashes.append(mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64)))
        starts.append(start + lo)
        ends.append(stop + lo)
    if not hashes:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, empty
    start = np.concatenate(starts)
    owner = np.searchsorted(offsets, start, "right") - 1
    return np.concatenate(hashes), owner, start, np.concatenate(ends)


def white_space() -> np.ndarray:
    """Separators of words [^\\x20\\x09-\\x0D]+."""
    separator = np.zeros(256, np.bool_)
    separator[[0x20, *range(0x09, 0x0E)]] = True
    return separator


def spans_of(owner: np.ndarray, rows: int) -> np.ndarray:
    """First index of each owner 0 to rows - 1 in the sorted array, and its length at the end."""
    return np.searchsorted(owner, np.arange(rows + 1))


def union(intervals: np.ndarray) -> np.ndarray:
    """Sorted, merged (start, end) rows; touching ones become one."""
    if len(intervals) < 2:
        return intervals
    intervals = intervals[np.argsort(intervals[:, 0], kind="stable")]
    reach = np.maximum.accumulate(intervals[:, 1])
    first = np.concatenate(([True], intervals[1:, 0] > reach[:-1]))
    last = np.concatenate((first[1:], [True]))
    return np.column_stack((intervals[first, 0], reach[last]))


def sample_of(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """At most `rows` rows: those of the least hashes of their keys. Of a large table few more than those are sorted."""
    share = min(1.0, (1.1 * rows + 200) / max(1, df.count()))
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << 40))
    return df.where(place <= int(share * (1 << 40))).orderBy(place, *keys).limit(rows)


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow; `function` takes and gives an iterator of batches."""
    return df.mapInArrow(function, schema)
