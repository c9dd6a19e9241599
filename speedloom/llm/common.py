"""Shared pieces of the operators: tables, staged results, slices of Arrow batches, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a worker holds as Python objects at a time (one document at least).
SLICE_BYTES = 1 << 22
#: Words whose hash a worker remembers before it starts anew.
WORD_MEMORY = 400_000
#: log2 of the bits of a filter that is sent to every worker: 2 MB, however many keys it holds.
FILTER_BITS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``; where it is unset, as in tests, one in a local session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir") + "/_staged"
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, so that a lost executor costs tasks and not steps."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Partitions for a shuffle of so many rows: at least the session's number, growing with the rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about so many bytes of text each."""
    if not batch.num_rows:
        return
    sizes = batch.column(column).fill_null("").cast(pa.binary())
    sizes = np.diff(np.frombuffer(sizes.buffers()[1], np.int32, len(sizes) + 1, sizes.offset * 4)).astype(np.int64) + 64
    block = np.cumsum(sizes) // size
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        yield batch.slice(lo, hi - lo)


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a slice; null is the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of the texts of a slice; null is the empty text."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hash of each word, remembered while a worker lives."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


HASHES = WordHashes()

M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * M2
    h = (h ^ (h >> np.uint64(27))) * M3
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n-word shingle in order; of the whole sequence if it is shorter; nothing without words."""
    n = min(n, len(words))
    if not n:
        return words
    last = len(words) - n + 1
    h = np.full(last, n, np.uint64)
    for i in range(n):
        h = (h ^ words[i : i + last]) * M1
        h ^= h >> np.uint64(29)
    return mixed(h)


def bit_filter(keys: DataFrame, column: str) -> bytes:
    """Bits of the 64-bit keys' low FILTER_BITS; the driver gets at most one value per bit of the filter."""
    low = keys.selectExpr(f"cast({column} & {(1 << FILTER_BITS) - 1} as int) as b").distinct().toArrow().column("b")
    bits = np.zeros(1 << FILTER_BITS, np.uint8)
    bits[low.to_numpy()] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes may be among the keys of a filter (uint8 view of bit_filter)."""
    low = (h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
    return ((bits[low >> 3] >> (low & 7).astype(np.uint8)) & 1).astype(bool)


def long_lists(rows: list[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit values as an Arrow list column."""
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int64, copy=False) if flat.dtype != np.uint64 else flat.view(np.int64)))


def whole_groups(batches, keys: list[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of complete groups, from batches sorted by the keys, and where each group starts and ends."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now]).combine_chunks()
        if (cuts := group_starts(held, keys))[-1]:
            yield held.slice(0, cuts[-1]).combine_chunks(), cuts
            held = held.slice(cuts[-1]).combine_chunks()
    if held is not None:
        yield held, [*group_starts(held, keys), held.num_rows]


def group_starts(rows: pa.Table, keys: list[str]) -> list[int]:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for key in keys:
        new[1:] |= np.diff(rows.column(key).to_numpy()) != 0
    return np.flatnonzero(new).tolist()
