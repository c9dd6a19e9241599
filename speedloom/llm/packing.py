"""Packing (3): first-fit decreasing over a tournament tree of free room, in random groups of pieces.

A document's ids, with an end id, are cut into pieces of at most LENGTH. Pieces are dealt into groups of about GROUP by a hash,
the number of groups growing with the input. In each group the pieces go, the longest first, into the first sequence with
room: a tournament tree over the sequences' room finds it in a logarithm of their number.

Null text counts as empty and consists of the end id alone. Repeated rows are packed once each. An empty table gives an empty
result. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from speedloom.llm.common import parts_for, slices, strings, whole_groups
from speedloom.llm.tokens import VOCABULARY, encoder

LENGTH = 2048
GROUP = 512
#: Pieces of a task, about: 64 MB of ids.
PART = 8192
END = 1


class Room:
    """Tournament tree over the free room of sequences; the first with enough of it wins."""

    def __init__(self, count: int, room: int):
        self.size = 1 << max(0, count - 1).bit_length()
        self.tree = [room] * (2 * self.size)

    def take(self, need: int) -> tuple[int, int]:
        """First sequence with the needed room, and the room it had."""
        tree, at = self.tree, 1
        while at < self.size:
            at *= 2
            at += tree[at] < need
        found, had = at - self.size, tree[at]
        tree[at] -= need
        while at > 1:
            at //= 2
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
        return found, had


def first_fit(lengths: list[int], room: int = LENGTH) -> list[tuple[int, int]]:
    """Sequence and offset of each piece; the lengths must not rise and none may exceed the room."""
    bins = Room(len(lengths), room)
    return [(found, room - had) for found, had in map(bins.take, lengths)]


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, end: int = END) -> DataFrame:
    """doc_id, start, length, doc_tokens and the ids (little-endian unsigned 32-bit) of each piece."""

    def rows(batches):
        encode, last = encoder(vocabulary), np.array([end], np.uint32)
        for batch in batches:
            for part in slices(batch):
                out = [[], [], [], [], []]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(strings(part))):
                    ids = np.concatenate([ids, last])
                    for at in range(0, len(ids), length):
                        piece = ids[at : at + length]
                        for column, value in zip(out, (doc_id, at, len(piece), len(ids), piece.tobytes())):
                            column.append(value)
                kinds = [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, start long, length long, doc_tokens long, ids binary")


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """The pieces with their sequence_id and offset in it."""
    size = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    count = size.n + int(size.bytes / (4 * length))
    groups = max(1, round(count / group))
    dealt = pieces(docs, vocabulary, length).withColumn("group", F.pmod(F.xxhash64("doc_id", "start", F.lit(1)), F.lit(groups)))
    dealt = dealt.repartition(parts_for(docs.sparkSession, count, PART), "group").sortWithinPartitions("group", F.desc("length"), "doc_id", "start")

    def rows(batches):
        for whole, starts in whole_groups(batches, ["group"]):
            lengths, names = whole.column("length").to_pylist(), whole.column("group").to_pylist()
            places = [(names[lo] << 24 | s, o) for lo, hi in zip(starts, starts[1:]) for s, o in first_fit(lengths[lo:hi], length)]
            out = whole.drop_columns(["group"])
            for k, name in enumerate(("sequence_id", "offset")):
                out = out.append_column(name, pa.array([x[k] for x in places], pa.int64()))
            yield from out.to_batches()

    schema = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
    return dealt.mapInArrow(rows, schema)
