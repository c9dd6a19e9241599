"""Token-id files (4): canonical length-limited Huffman codes of ids.

Documents are ordered by doc_id (ranges to tasks, sorted inside), encoded into ids with an end id and kept as a staged table;
global counts of the ids give code lengths by the package-merge method. A block holds whole documents of about BLOCK ids: their ids
and lengths, the bits, and the bit offset of every STEP-th id. A block is decoded alone: all stretches between checkpoints advance
together, one id at a time, by a table of the next LIMIT bits. The files are Parquet (one row a block, and the table of code lengths).

Null text counts as empty (the end id alone); equal doc_ids stand beside each other. Documents without a doc_id come first. An empty
table gives empty files and an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from speedloom.llm.common import shared_folder, slices, stage, strings
from speedloom.llm.tokens import VOCABULARY, encoder

#: Longest code; the decoding table has 2 ** LIMIT entries.
LIMIT = 18
BLOCK = 1 << 16
STEP = 64
END = 0
BLOCK_SCHEMA = "part int, block long, n_tokens long, doc_ids array<long>, lengths array<long>, checkpoints binary, bits binary"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each symbol with a count, none longer than the limit, of least total size; 0 without a count."""
    symbols = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    n = len(symbols)
    if n <= 1:
        out[symbols] = 1
        return out
    if n > 1 << limit:
        raise ValueError(f"{n} symbols have no codes of {limit} bits")
    order = symbols[np.argsort(counts[symbols], kind="stable")]
    leaves = counts[order].astype(np.int64)
    packages, levels = np.empty(0, np.int64), []
    for _ in range(limit):
        items = np.concatenate([leaves, packages])
        rank = np.argsort(items, kind="stable")
        levels.append(rank < n)
        items = items[rank]
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    taken = 2 * n - 2
    for is_leaf in reversed(levels):
        used = int(is_leaf[:taken].sum())
        out[order[:used]] += 1
        taken = 2 * (taken - used)
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code of each symbol: shorter codes first, equal lengths in the order of the symbols."""
    symbols = np.flatnonzero(lengths)
    order = symbols[np.argsort(lengths[symbols], kind="stable")]
    codes = np.zeros(len(lengths), np.uint64)
    size = np.cumsum(1 << (LIMIT - lengths[order]))
    codes[order] = (np.concatenate([[0], size[:-1]]) >> (LIMIT - lengths[order])).astype(np.uint64) if len(order) else codes[order]
    return codes


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """The bits of the ids and the bit offset of every STEP-th one."""
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    begin = ends - sizes
    word = begin >> 5
    value = codes[ids] << (64 - (begin & 31) - sizes).astype(np.uint64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
    sums, word = np.add.reduceat(value, first), word[first]
    out = np.zeros((int(ends[-1]) >> 5) + 2, np.uint64)
    out[word] += sums >> np.uint64(32)
    out[word + 1] += sums & np.uint64(0xFFFFFFFF)
    return out.astype(">u4").tobytes(), begin[::STEP].astype("<u4" if ends[-1] < 1 << 32 else "<u8").tobytes()


class Decoder:
    """Symbol and code length by the next LIMIT bits."""

    def __init__(self, lengths: np.ndarray):
        symbols = np.flatnonzero(lengths)
        order = symbols[np.argsort(lengths[symbols], kind="stable")]
        times = 1 << (LIMIT - lengths[order])
        self.symbol, self.length = (np.zeros(1 << LIMIT, k) for k in (np.uint32, np.int64))
        self.symbol[: times.sum()], self.length[: times.sum()] = np.repeat(order, times), np.repeat(lengths[order], times)

    def __call__(self, bits: bytes, checkpoints: bytes, count: int) -> np.ndarray:
        words = np.frombuffer(bits, ">u4").astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        lanes = -(-count // STEP)
        at = np.frombuffer(checkpoints, "<u4" if len(checkpoints) == 4 * lanes else "<u8").astype(np.int64)
        out = np.empty((lanes, STEP), np.uint32)
        last = count - (lanes - 1) * STEP
        for i in range(STEP):
            if i == last and lanes:  # the last stretch may be shorter
                at = at[:-1]
            key = ((pairs[at >> 5] << (at & 31).astype(np.uint64)) >> np.uint64(64 - LIMIT)).astype(np.int64)
            out[: len(at), i] = self.symbol[key]
            at = at + self.length[key]
        return out.reshape(-1)[:count]


def token_table(docs: DataFrame, vocabulary: str, end: int) -> DataFrame:
    """part, doc_id, n, ids of the documents in the order of doc_id; staged, with the ids compressed.

    Each task ends with a row that holds its counts of ids and no document (``counts`` is null in all others).
    """

    def rows(batches):
        encode, last, press = encoder(vocabulary), np.array([end], np.uint32).tobytes(), zstandard.ZstdCompressor(level=1)
        number, total = TaskContext.get().partitionId(), np.zeros(end + 1, np.int64)
        names = ["part", "doc_id", "n", "ids", "counts"]
        for batch in batches:
            for part in slices(batch):
                found = encode(strings(part))
                more = np.bincount(np.concatenate(found), minlength=len(total))
                more[: len(total)] += total
                more[end] += len(found)
                total = more
                ids = [x.tobytes() + last for x in found]
                n = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(ids), pa.int32()), part.column("doc_id"), n, pa.array([press.compress(x) for x in ids]), pa.nulls(len(ids), pa.binary())], names=names)
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *(pa.nulls(1, k) for k in (pa.int64(), pa.int64(), pa.binary())), pa.array([press.compress(total.tobytes())])], names=names)

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return stage(ordered.mapInArrow(rows, "part int, doc_id long, n long, ids binary, counts binary"), "token-ids")


def unpressed(batch: pa.RecordBatch) -> list[np.ndarray]:
    press = zstandard.ZstdDecompressor()
    return [np.frombuffer(press.decompress(x), np.uint32) for x in batch.column("ids").to_pylist()]


def id_counts(tokens: DataFrame) -> DataFrame:
    """id, n over all documents, from the counts that each task has told."""

    def rows(batches):
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for x in batch.column("counts").to_pylist():
                total = np.frombuffer(press.decompress(x), np.int64)
                full = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["id", "n"])

    told = tokens.select("counts").where("counts is not null")
    return told.mapInArrow(rows, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end: int = END, block: int = BLOCK) -> None:
    """Write ``path``/codes (id, bits: as many rows as the vocabulary has ids at most) and ``path``/blocks."""
    spark = docs.sparkSession
    tokens = token_table(docs, vocabulary, end)
    counted = id_counts(tokens).toArrow()
    counts = np.zeros(int(max(counted.column("id").to_pylist(), default=0)) + 1, np.int64)
    counts[counted.column("id").to_numpy()] = counted.column("n").to_numpy()
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": used, "bits": lengths[used]})).coalesce(1).write.parquet(f"{path}/codes")
    sent = spark.sparkContext.broadcast(lengths)

    def rows(batches):
        lengths = sent.value
        codes = canonical_codes(lengths)
        held, size, number, part = [], 0, TaskContext.get().partitionId() << 32, None

        def closed():
            ids = np.concatenate([x for _, x in held])
            bits, checkpoints = pack_bits(ids, codes, lengths)
            values = (part, number, len(ids), [i for i, _ in held], [len(x) for _, x in held], checkpoints, bits)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[x.split()[0] for x in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            for here, doc_id, ids in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), unpressed(batch)):
                if held and (size >= block or here != part):
                    yield closed()
                    held, size, number = [], 0, number + 1
                part = here
                held.append((doc_id, ids))
                size += len(ids)
        if held:
            yield closed()

    tokens.where("counts is null").select("part", "doc_id", "ids").mapInArrow(rows, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, decoded from the files."""
    table = spark.read.parquet(f"{path}/codes").toArrow()
    lengths = np.zeros(int(max(table.column("id").to_pylist(), default=0)) + 1, np.int64)
    lengths[table.column("id").to_numpy()] = table.column("bits").to_numpy()
    sent = spark.sparkContext.broadcast(lengths)

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    index = blocks.select("part", "block", "n_tokens", F.coalesce(F.col("doc_ids")[0], F.lit(-(2**63))).alias("first"), F.element_at("doc_ids", -1).alias("last"))
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    inside = W.partitionBy("part").orderBy("first", F.col("last").asc_nulls_first(), "block").rowsBetween(W.unboundedPreceding, 0)
    index = index.withColumn("inside", F.sum("n_tokens").over(inside) - F.col("n_tokens"))
    index = index.join(parts, "part").select("block", (F.col("before") + F.col("inside")).alias("before"))

    def rows(batches):
        decode = Decoder(sent.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode(row["bits"], row["checkpoints"], row["n_tokens"])
                size = np.array(row["lengths"], np.int64)
                ends = np.cumsum(size)
                each = [ids[lo:hi].tobytes() for lo, hi in zip((ends - size).tolist(), ends.tolist())]
                out = [pa.array([row["block"]] * len(size), pa.int64()), pa.array(row["doc_ids"], pa.int64()), pa.array(ends - size), pa.array(size), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                out += [pa.array(each)] * with_ids
                yield pa.RecordBatch.from_arrays(out, names=["block", "doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(out)])

    schema = "block long, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    read = blocks.select("block", "n_tokens", "doc_ids", "lengths", "checkpoints", "bits").mapInArrow(rows, schema).join(index, "block")
    return read.withColumn("start", F.col("start") + F.col("before")).drop("block", "before")


def token_files(docs: DataFrame) -> DataFrame:
    """Write the files of the documents to the shared folder and read them back, without the ids."""
    path = f"{shared_folder(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, path)
    return read_token_files(docs.sparkSession, path, with_ids=False)
