"""Repeated passages (11): Burrows-Wheeler transforms of shards, merged by refining their interleave.

Every LENGTH-byte window of a text has an anchor: the GRAM bytes in it with the least hash (the first of equals). Equal windows
have equal anchors, so documents that share a window share an anchor, and windows are only compared with those of their anchor.

Equal texts come first: all of them but the one with the smallest doc_id are removed whole, and only that one takes part below.

1. Each worker sorts the anchors of its texts; buckets of anchors find those in more than one text.
2. Texts are joined with their own repeated anchors. The windows that share an occurrence of one form a string of at most
   LENGTH + SPAN - 1 bytes; equal strings of a worker count once, with their smallest document. The strings of a
   shard are sorted into one Burrows-Wheeler transform per bucket of anchors, and travel with those of the neighbouring buckets
   in one row (a part): shards and buckets both grow with the input, so a row for each pair of them would grow with its square.
3. A bucket merges the transforms of all shards. Their order is never sorted again: each suffix gets the class of its first
   symbols, the classes of sorted shards are interleaved, and a round refines them by the class that stands so many symbols later, found by
   following the transform. Classes over 7, 14, 28 and then LENGTH symbols are the intervals of suffixes with a common prefix of
   that length. The smallest document of a window's class goes back to the shard.
4. A shard turns these into spans of its documents, and the texts are joined with their spans.

Anchors of more than HOT strings (or so many that a filter of 2 MB would be full of them) have their windows dealt by the window
itself, so that no bucket holds the varying surroundings of a frequent passage; a window that all documents hold is one string per
shard. The filter is the same for all documents, and what passes it by chance only costs time.

Null texts are empty and give zeros. Of rows with the same doc_id none has the smaller id: they remove nothing from each other. A null doc_id counts as
greater than all others. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from speedloom.llm.common import M1, bit_filter, mixed, parts_for, passes, raw, slices, stage, whole_groups

LENGTH, GRAM = 50, 18
SPAN = LENGTH - GRAM + 1
#: Windows whose anchors are looked for at a time; positions in them take POSITION bits of the compared hashes.
CHUNK, POSITION = 1 << 18, np.uint64(20)
#: Text bytes for each bucket of anchors.
BUCKET_BYTES = 1 << 20
#: Buckets of a part: they are sent in one row, so that rows stay long when shards and buckets are many.
TOGETHER = 16
#: Anchors that a worker sorts at a time, and distinct strings or their places in a shard.
ANCHORS, STRINGS, PLACES = 1 << 19, 1 << 18, 1 << 20
#: Symbols of a shard that are sorted at a time (one bucket at least).
SYMBOLS = 1 << 17
#: Bytes of text, compressed or not, that are held as objects at a time (one document at least).
AT_ONCE = 1 << 20
HOT, MOST_HOT = 1 << 14, 1 << 20
NEVER = np.iinfo(np.int64).max


def pressed(docs: DataFrame, *names: str) -> DataFrame:
    """The columns and the compressed bytes of the text: half of what Spark's own compression leaves of them in a shuffle."""

    def rows(batches):
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in slices(batch, size=AT_ONCE):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array([press(x) for x in raw(part)], pa.binary())], names=[*names, "data"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return docs.select(*names, "text").mapInArrow(rows, ", ".join(f"{c} {kinds[c]}" for c in names) + ", data binary")


def unpressed(part: pa.RecordBatch) -> list[bytes]:
    press = zstandard.ZstdDecompressor().decompress
    return [press(x) for x in part.column("data").to_pylist()]


PRESS, UNPRESS = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(x: np.ndarray) -> bytes:
    """Values of a fixed width, compressed byte by byte of their places."""
    return PRESS.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def unpack(data: bytes, kind: type = np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(UNPRESS.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def gram_hashes(buffer: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of so many bytes."""
    cur, power, done, off, span = buffer.astype(np.uint64) + np.uint64(1), M1, None, 0, 1
    with np.errstate(over="ignore"):
        while True:
            if size & span:
                n = len(buffer) - off - span + 1
                done, off = (cur[:n], span) if done is None else (done[:n] * power + cur[off : off + n], off + span)
            if 2 * span > size:
                return mixed(done)
            cur, power, span = cur[:-span] * power + cur[span:], power * power, 2 * span


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of so many values."""
    span = 1
    while 2 * span <= width:
        x, span = np.minimum(x[:-span], x[span:]), 2 * span
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def anchored(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, first window, number of windows, hash of the anchor.

    48 bits of the hash: anchors that agree by chance are compared with each other in vain, and their bytes decide.
    """
    sizes = np.array([len(x) for x in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    inside = np.zeros(len(buffer) + 1, np.int8)
    long = sizes >= LENGTH
    inside[begin[:-1][long]] += 1
    inside[begin[1:][long] - LENGTH + 1] -= 1
    inside = np.cumsum(inside, dtype=np.int8).astype(bool)
    found = []
    for at in range(0, len(buffer) - LENGTH + 1, CHUNK):
        h = gram_hashes(buffer[at : at + CHUNK + LENGTH - 1], GRAM)
        tagged = (h >> POSITION << POSITION) | np.arange(len(h), dtype=np.uint64)
        owner = (least_of(tagged, SPAN) & np.uint64((1 << int(POSITION)) - 1)).astype(np.int64)
        owner[~inside[at : at + len(owner)]] = -1
        first = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
        count = np.diff(np.concatenate([first, [len(owner)]]))
        kept = owner[first] >= 0
        first, count = first[kept], count[kept]
        found.append((first + at, count, mixed(h[owner[first]]) >> np.uint64(16)))  # least hashes are small: mixed, they fill all buckets alike
    if not found:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    first, count, value = (np.concatenate([x[i] for x in found]) for i in range(3))
    text = np.searchsorted(begin, first, "right") - 1
    return text, first - begin[text], count, value


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of 48-bit hashes, the smaller ones in the first."""
    return ((h >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def cuts(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts, and the end."""
    return np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]]) if len(x) else np.zeros(1, np.int64)


def of_texts(keys: np.ndarray, values: np.ndarray, parts: int) -> tuple[np.ndarray, list[pa.Array]]:
    """Pairs of text and anchor in a row for each group of texts that has some: the groups; texts, how many anchors each has, and these."""
    group = keys % parts
    order = np.lexsort((keys, group))
    keys, values, group = keys[order], values[order].view(np.int64), group[order]
    at, rows = cuts(group), []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        ends = cuts(keys[lo:hi])
        rows.append((pack(keys[lo:hi][ends[:-1]]), pack(np.diff(ends)), pack(values[lo:hi])))
    return group[at[:-1]], [pa.array([x[i] for x in rows], pa.binary()) for i in range(3)]


def distinct_pairs(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of 48-bit values and keys, by value; they are sorted in one word where the place of the key fits beside the value."""
    names, place = np.unique(keys, return_inverse=True)
    width = max(1, int(len(names) - 1).bit_length())
    if 48 + width > 64:
        order = np.lexsort((place, values))
        values, place = values[order], place[order]
        new = np.concatenate([[True], (values[1:] != values[:-1]) | (place[1:] != place[:-1])])
        return values[new], names[place[new]]
    both = np.sort(values << np.uint64(width) | place.astype(np.uint64))
    both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return both >> np.uint64(width), names[(both & np.uint64((1 << width) - 1)).astype(np.int64)]


def stands_in(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the known ones."""
    if not len(known):
        return np.zeros(len(x), bool)
    known = np.sort(known)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


KNOWN = "prints binary, sizes binary, known binary"
ASKED = f"part long, {KNOWN}, anchors binary, documents binary, counts binary"
ANSWERED = f"part long, {KNOWN}, frequent array<long>"


def repeated_anchors(docs: DataFrame, parts: int, hot: int) -> DataFrame:
    """The anchors that a text (named by its print) shares with others: rows of ``of_texts``; and ``frequent``: anchors of more than ``hot`` texts. Staged.

    Texts are answered in as many groups as there are parts: a row for each text and part would be nearly one for each anchor where parts are many.
    """

    def asked(keys: np.ndarray, values: np.ndarray):
        values, keys = distinct_pairs(values, keys)
        ends = cuts(values)
        count = np.diff(ends)
        several = np.repeat(count > 1, count)
        names = [x.split()[0] for x in ASKED.split(", ")]
        nothing = lambda n: [pa.nulls(n, pa.binary())] * 3
        group, known = of_texts(keys[several], values[several], parts)
        yield pa.RecordBatch.from_arrays([pa.array(group), *known, *nothing(len(group))], names=names)
        head, owner = values[ends[:-1]], keys[ends[:-1]]
        part = bucket_of(head, parts)
        at = cuts(part)
        runs = list(zip(at[:-1].tolist(), at[1:].tolist()))
        steps = [pack(np.diff(head[lo:hi], prepend=np.uint64(0))) for lo, hi in runs]
        columns = [pa.array([pack(x[lo:hi].astype(np.int64)) for lo, hi in runs], pa.binary()) for x in (owner, count)]
        yield pa.RecordBatch.from_arrays([pa.array(part[at[:-1]]), *nothing(len(runs)), pa.array(steps, pa.binary()), *columns], names=names)

    def ask(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, size=AT_ONCE):
                text, _, _, value = anchored(raw(part))
                held.append((part.column("print").to_numpy()[text], value))
                size += len(value)
                if size >= ANCHORS:
                    yield from asked(*(np.concatenate([x[i] for x in held]) for i in (0, 1)))
                    held, size = [], 0
        if size:
            yield from asked(*(np.concatenate([x[i] for x in held]) for i in (0, 1)))

    def answer(batches):
        names = [x.split()[0] for x in ANSWERED.split(", ")]
        for whole, starts in whole_groups(batches, ["part"]):
            for lo, hi in zip(starts, starts[1:]):
                rows = whole.slice(lo, hi - lo)
                mine = rows.filter(rows.column("known").is_valid()).select(names[:4])
                for x in mine.append_column("frequent", pa.nulls(mine.num_rows, pa.list_(pa.int64()))).to_batches():
                    yield x
                rows = rows.filter(rows.column("known").is_null())
                if not rows.num_rows:
                    continue
                values = np.concatenate([np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in rows.column("anchors").to_pylist()])
                owner, count = (np.concatenate([unpack(x) for x in rows.column(c).to_pylist()]) for c in ("documents", "counts"))
                order = np.argsort(values)
                values, owner, count = values[order], owner[order], count[order]
                ends = cuts(values)
                total = np.add.reduceat(count, ends[:-1])
                several = np.repeat((np.diff(ends) > 1) & (total > 1), np.diff(ends)) & (count == 1)  # with more, the worker knew itself
                group, known = of_texts(owner[several], values[several], parts)
                frequent = values[ends[:-1]][total > hot].view(np.int64)
                if len(frequent):
                    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.binary())] * 3, pa.array([frequent], pa.list_(pa.int64()))], names=names)
                yield pa.RecordBatch.from_arrays([pa.array(group), *known, pa.nulls(len(group), pa.list_(pa.int64()))], names=names)

    spark = docs.sparkSession
    dealt = docs.mapInArrow(ask, ASKED).repartition(parts_for(spark, parts, 1), "part").sortWithinPartitions("part")
    return stage(dealt.mapInArrow(answer, ANSWERED), "repeated-anchors")


def by_text(anchors: DataFrame, parts: int) -> DataFrame:
    """print, anchors (packed) of each text that shares some."""

    def rows(batches):
        for whole, starts in whole_groups(batches, ["part"]):
            for lo, hi in zip(starts, starts[1:]):
                prints, sizes, known = (np.concatenate([unpack(x) for x in whole.slice(lo, hi - lo).column(c).to_pylist()]) for c in ("prints", "sizes", "known"))
                prints = np.repeat(prints, sizes)
                order = np.argsort(prints)
                prints, known = prints[order], known[order]
                at = cuts(prints)
                told = [pack(np.sort(known[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(prints[at[:-1]]), pa.array(told, pa.binary())], names=["print", "anchors"])

    dealt = anchors.where("part is not null").drop("frequent").repartition(parts_for(anchors.sparkSession, parts, 1), "part")
    return dealt.sortWithinPartitions("part").mapInArrow(rows, "print long, anchors binary")


def symbols(strings: list[bytes]) -> np.ndarray:
    """The strings, each byte plus one, each string with a 0 after it."""
    ends = np.cumsum([len(x) + 1 for x in strings])
    out = np.zeros(int(ends[-1]), np.uint16)
    text = np.ones(len(out), bool)
    text[ends - 1] = False
    out[text] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    return out


def in_order(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys (of so many bits) in order, equal ones as they stand, and the sorted keys: place and key are sorted in one word where both fit."""
    width = max(1, int(len(key) - 1).bit_length())
    if bits + width > 63:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = np.sort(key << width | np.arange(len(key)))
    return both & ((1 << width) - 1), both >> width


def starts_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value of a sorted run the place where its equals start, and which ones start."""
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return np.flatnonzero(new)[np.cumsum(new) - 1], new


def named(key: np.ndarray, old: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Names of the classes of sorted keys inside sorted old classes (none: one class), and which are in company: the old name plus the place in it."""
    start, new = starts_of(key)
    company = ~new
    company[:-1] |= ~new[1:]
    if old is not None:
        start += old - starts_of(old)[0]
    return start, company


def transform(strings: list[bytes], groups: np.ndarray | None = None) -> np.ndarray:
    """Burrows-Wheeler transform of sorted strings: the symbol before each suffix, in the order of the suffixes, equal ones in the order of the strings.

    With a group of each string (rising), the transforms of the groups' strings, one after another.
    """
    text = symbols(strings)
    n = len(text)
    size = np.array([len(x) + 1 for x in strings], np.int64)
    left = (np.repeat(np.cumsum(size), size) - np.arange(n)).astype(np.int32)  # symbols up to the end, with it
    used = np.flatnonzero(np.bincount(text, minlength=257))  # symbols by rank, so that more of them fit in a key
    bits = max(1, int(len(used) - 1).bit_length())
    rank = np.zeros(257, np.int64)
    rank[used] = np.arange(len(used))
    width = max(1, int(n - 1).bit_length())
    most = max(1, (63 - width) // bits)
    span, word = 1, rank[text]
    while span < most:  # nothing follows an end: its rank is 0
        more = min(span, most - span)
        following = np.zeros(n, np.int64)
        following[:-span] = word[span:] >> bits * (span - more)
        following *= left > span
        span, word = span + more, word << bits * more | following
    some, word = in_order(word, span * bits)
    start = np.empty(n, np.int64)
    start[some], company = named(word)
    while span <= size.max():
        some = some[company]  # in the order of their classes
        if not len(some):
            break
        later = start[np.minimum(some + span, n - 1)] * (left[some] > span)
        order, key = in_order(start[some] << width | later, 2 * width)
        some = some[order]
        start[some], company = named(key, key >> width)
        span *= 2
    order = in_order(start, width)[0]
    if groups is not None:
        of = np.repeat(np.cumsum(np.diff(groups, prepend=groups[:1]) != 0), size)[order]
        order = order[np.argsort(of.astype(np.uint16) if of.max() < 1 << 16 else of, kind="stable")]
    return text[order - 1]


def window_classes(before: np.ndarray, lengths: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Class of each window, in the order of the shards, their strings and the windows' places: equal windows, equal class.

    ``before``: the shards' transforms, one after another, ``lengths``: how long each is, ``count``: windows of each string.

    The transforms are interleaved by classes of suffixes that begin with the same symbols. A shard's suffixes are in
    order, so a round merges sorted runs; it splits classes by the class that stands so many symbols later.
    """
    place = np.int32 if len(before) < 1 << 31 else np.int64
    after = np.argsort(before, kind="stable").astype(place)  # from a suffix to the next shorter one of its shard
    shard = np.repeat(np.arange(len(lengths), dtype=np.uint16 if len(lengths) <= 1 << 16 else np.int64), lengths)
    after = after[np.argsort(shard[after], kind="stable")]
    del shard
    word = before[after].astype(np.int64)
    whole = np.flatnonzero(before == 0)  # suffixes that are whole strings, in the order of the strings
    ends = np.flatnonzero(word == 0)
    after[ends] = ends  # nothing follows an end
    by2 = after[after]
    by4 = by2[by2]
    word = word << 9 | word[after]
    word = word << 18 | word[by2]
    word = word << 27 | word[by4] >> 9
    by7 = by4[by2[after]]
    del by2, by4
    by14 = by7[by7]
    by22 = by14[by7[after]]
    base = np.concatenate([[0], np.cumsum(count)])
    rows, row = np.empty(int(base[-1]), place), whole
    for step in range(int(count.max())):
        active = count > step
        rows[base[:-1][active] + step] = row[active]
        row = after[row]
    n = len(before)
    width = np.int64(max(1, int(n - 1).bit_length()))
    start = np.empty(n, np.int64)
    order = np.argsort(word)  # equal words get one name: their order does not matter, here and below
    start[order], company = named(word[order])
    shared = np.zeros(n, bool)
    shared[order] = company
    del word, order, company
    # What a window's class is made of: its first 28 symbols and those from the 22nd on, each of two times 14, each of two times 7.
    windows = np.zeros(n, bool)
    windows[rows] = True
    by28 = windows.copy()
    by28[by22[rows]] = True
    made_of = by28.copy()
    made_of[by14[by28]] = True
    for needed, jump in ((made_of, by7), (by28, by14), (windows, by22)):
        some = np.flatnonzero(needed & shared)
        key = start[some] << width | start[jump[some]]
        order, key = in_order(key, 2 * int(width))
        some = some[order]
        shared[some] = False
        start[some], company = named(key, key >> width)
        shared[some[company]] = True
    return start[rows]


def places_of(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places in runs that start here and are so long."""
    return np.repeat(start - np.cumsum(length) + length, length) + np.arange(int(length.sum()))


def part_minima(held: np.ndarray, before: np.ndarray, owner: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """For each shard, the smallest owner of a string with an equal window in its bucket, for each window of its strings in order.

    ``held``: strings of each shard (row) and bucket; the others: what the shards tell, one after another. Shards are many and may hold little of a bucket: no step is made for each of them.
    """
    strings = np.concatenate([[0], np.cumsum(held)])  # where what a shard holds of a bucket starts
    symbols, windows = (np.concatenate([[0], np.cumsum(x)])[strings] for x in (count + LENGTH, count))
    out = np.empty(int(windows[-1]), np.int64)
    for b in range(held.shape[1]):
        at = np.arange(len(held)) * held.shape[1] + b
        runs = [(x[at], x[at + 1] - x[at]) for x in (strings, symbols, windows)]
        some, mine, asked = (places_of(*x) for x in runs)
        if not len(some):
            continue
        classes = window_classes(before[mine], runs[1][1], count[some])
        least = np.full(len(mine), NEVER)
        np.minimum.at(least, classes, np.repeat(owner[some], count[some]))
        out[asked] = least[classes]
    cut = windows[:: held.shape[1]].tolist()
    return [out[lo:hi] for lo, hi in zip(cut[:-1], cut[1:])]


def window_minima(transforms: list[np.ndarray], owners: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """``part_minima`` of a single bucket."""
    return part_minima(np.array([[len(x)] for x in owners]), *map(np.concatenate, (transforms, owners, counts)))


SHARD = "shard string, part long, held binary, transform binary, owners binary, counts binary, documents binary, prints binary, of binary, at binary, string binary"


def shards(docs: DataFrame, anchors: DataFrame, buckets: int) -> DataFrame:
    """Transforms of the strings around repeated anchors (a row per shard and part, ``held``: strings of each bucket) and where the strings stand (a row per shard). Staged."""
    frequent = anchors.where("part is null").select(F.explode("frequent").alias("a"))
    sent = docs.sparkSession.sparkContext.broadcast(bit_filter(frequent, "a"))  # 2 MB whatever the input
    firsts = docs.groupBy("print").agg(F.min("key").alias("key"))
    of_doc = by_text(anchors, -(-buckets // TOGETHER)).join(firsts, "print")

    def rows(batches):
        bits = np.frombuffer(sent.value, np.uint8)
        strings: dict[bytes, int] = {}
        bucket, held, documents = [], [], []

        def add(part: pa.RecordBatch) -> int:
            texts = unpressed(part)
            text, first, count, value = anchored(texts)
            known = [unpack(x) for x in part.column("anchors").to_pylist()]
            of = np.repeat(np.arange(part.num_rows), [len(x) for x in known])
            mark = lambda v, i: mixed(v ^ (i.astype(np.uint64) + np.uint64(1)) * M1)
            repeated = stands_in(mark(value, text), mark(np.concatenate(known).view(np.uint64), of))
            text, first, count, value = (x[repeated] for x in (text, first, count, value))
            dealt = passes(bits, value)  # each window of frequent anchors is a string of its own
            times = np.where(dealt, count, 1)
            step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            text, first, value, dealt = (np.repeat(x, times) for x in (text, first, value, dealt))
            first, count = first + step, np.where(dealt, 1, np.repeat(count, times))
            number, places = np.empty(len(text), np.int64), bucket_of(value, buckets).tolist()
            for k, (i, lo, n, own, place) in enumerate(zip(text.tolist(), first.tolist(), count.tolist(), dealt.tolist(), places)):
                x = texts[i][lo : lo + n + LENGTH - 1]
                at = strings.get(x)
                if at is None:
                    at = strings[x] = len(strings)
                    bucket.append(bucket_of(np.uint64(xxhash.xxh64_intdigest(x) >> 16), buckets) if own else place)
                number[k] = at
            held.append((text + sum(len(x[0]) for x in documents), first, number))
            documents.append(tuple(part.column(c).to_numpy() for c in ("key", "print")))
            return len(text)

        def closed():
            of, first, number = (np.concatenate([x[i] for x in held]) for i in range(3))
            keys, prints = (np.concatenate([x[i] for x in documents]) for i in (0, 1))
            least = np.full(len(strings), NEVER)
            np.minimum.at(least, number, keys[of])
            names, place = list(strings), np.array(bucket, np.int64)
            order = np.argsort(place, kind="stable")
            at = cuts(place[order])
            order = np.array([i for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()) for i in sorted(order[lo:hi].tolist(), key=names.__getitem__)], np.int64)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            place = place[order]
            size = np.array([len(x) for x in names], np.int64)[order] - LENGTH + 1
            ends = np.concatenate([[0], np.cumsum(size + LENGTH)])  # in symbols, each string with its end
            block = at[:-1][cuts(ends[at[:-1]] // SYMBOLS)[:-1]].tolist()  # whole buckets
            told = np.concatenate([transform([names[i] for i in order[lo:hi].tolist()], place[lo:hi]) for lo, hi in zip(block, [*block[1:], len(order)])])
            name, fields = uuid.uuid4().hex, [x.split()[0] for x in SHARD.split(", ")]
            at = cuts(place // TOGETHER)
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                part = int(place[lo]) // TOGETHER
                columns = np.bincount(place[lo:hi] - part * TOGETHER, minlength=TOGETHER), told[ends[lo] : ends[hi]], least[order[lo:hi]], size[lo:hi]
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int64()), *[pa.array([v], pa.binary()) for v in (*map(pack, columns), *[None] * 5)]], names=fields)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.nulls(1, pa.int64()), *[pa.array([v], pa.binary()) for v in (None, None, None, pack(size), pack(keys), pack(prints), pack(of), pack(first), pack(rank[number]))]], names=fields)

        places = 0
        for batch in batches:
            for part in slices(batch, "data", AT_ONCE):
                places += add(part)
                if len(strings) >= STRINGS or places >= PLACES:
                    yield from closed()
                    strings.clear(), bucket.clear(), held.clear(), documents.clear()
                    places = 0
        if places:
            yield from closed()

    told = pressed(docs, "key", "print").join(of_doc, ["key", "print"]).select("key", "print", "data", "anchors")
    return stage(told.mapInArrow(rows, SHARD), "passage-shards")


def merged_shards(shards: DataFrame, parts: int) -> DataFrame:
    """shard, answers: (part, lengths, values) of the runs of the smallest documents over the shard's windows."""

    def rows(batches):
        for whole, starts in whole_groups(batches, ["part"]):
            for lo, hi in zip(starts, starts[1:]):
                group = whole.slice(lo, hi - lo)
                read = lambda name, kind=np.int64: np.concatenate([unpack(x, kind) for x in group.column(name).to_pylist()])  # noqa: B023, E731
                lengths, values = [], []
                for least in part_minima(read("held").reshape(-1, TOGETHER), read("transform", np.uint16), read("owners"), read("counts")):
                    at = cuts(least)
                    lengths.append(pack(np.diff(at)))
                    values.append(pack(least[at[:-1]]))
                yield pa.RecordBatch.from_arrays([*(group.column(c).combine_chunks() for c in ("shard", "part")), pa.array(lengths, pa.binary()), pa.array(values, pa.binary())], names=["shard", "part", "lengths", "least"])

    mine = shards.where("part is not null").select("shard", "part", "held", "transform", "owners", "counts")
    dealt = mine.repartition(parts_for(shards.sparkSession, parts, 1), "part").sortWithinPartitions("part")
    merged = dealt.mapInArrow(rows, "shard string, part long, lengths binary, least binary")
    return merged.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("part", "lengths", "least"))).alias("answers"))


def joined_spans(first: np.ndarray, last: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans, sorted by start within each document (``new``: where one starts), joined where they touch; which start one."""
    far = np.int64(1) << 40
    shift = np.cumsum(new) * far  # documents one after another
    reach = np.maximum.accumulate(last + shift)
    opens = np.concatenate([[True], first[1:] + shift[1:] > reach[:-1]]) if len(first) else np.zeros(0, bool)
    closes = np.concatenate([opens[1:], [True]]) if len(first) else opens
    return first[opens], reach[closes] - shift[closes], opens


def document_spans(shards: DataFrame, answers: DataFrame) -> DataFrame:
    """key, print, first, last: removed runs of bytes (last exclusive) of each document as far as one shard knows them."""

    def rows(batches):
        for batch in batches:
            for row in batch.to_pylist():
                size, keys, prints, of, at, string = (unpack(row[c]) for c in ("counts", "documents", "prints", "of", "at", "string"))
                lengths, least = (np.concatenate([unpack(a[c]) for a in row["answers"]]) for c in ("lengths", "least"))
                base = np.concatenate([[0], np.cumsum(size)])
                ends = np.cumsum(lengths)
                lo = np.searchsorted(ends, base[string], "right")  # the runs that a string's windows lie in
                hi = np.searchsorted(ends, base[string + 1] - 1, "right")
                times = hi - lo + 1
                run = np.repeat(lo, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                key, of, at, string = (np.repeat(x, times) for x in (keys[of], of, at, string))
                first = at + np.maximum(ends[run] - lengths[run], base[string]) - base[string]
                last = at + np.minimum(ends[run], base[string + 1]) - base[string] + LENGTH - 1
                gone = least[run] < key
                of, first, last = of[gone], first[gone], last[gone]
                order = np.lexsort((first, of))
                of, first, last = of[order], first[order], last[order]
                if not len(of):
                    continue
                first, last, opens = joined_spans(first, last, np.concatenate([[True], of[1:] != of[:-1]]))
                ends = cuts(of[opens])
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in (first, last)]
                told = of[opens][ends[:-1]]
                yield pa.RecordBatch.from_arrays([pa.array(keys[told]), pa.array(prints[told]), *lists], names=["key", "print", "first", "last"])

    places = shards.where("part is null").drop("part", "held", "transform", "owners")
    return places.join(answers, "shard").mapInArrow(rows, "key long, print long, first array<long>, last array<long>")


def later_copies(docs: DataFrame) -> DataFrame:
    """key, print of the documents whose whole text, long enough, stands in one with a smaller key."""
    long = docs.where(F.octet_length("text") >= LENGTH).select("key", "print", F.sha2("text", 256).alias("digest"))
    several = long.groupBy("digest").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most")
    return long.join(several, "digest").where("key > least").select("key", "print").distinct()


def repeated_passages(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept: the bytes left) of every document."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first().bytes
    buckets = max(1, -(-size // BUCKET_BYTES))
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NEVER))).alias("key"), F.shiftrightunsigned(F.xxhash64("text"), 16).alias("print"), "text")
    parts = -(-buckets // TOGETHER)
    anchors = repeated_anchors(keyed.select("print", "text"), parts, max(HOT, size // (SPAN + 1) * 2 // MOST_HOT))
    told = shards(keyed.drop("doc_id"), anchors, buckets)
    spans = document_spans(told, merged_shards(told, parts))
    whole = F.array(F.lit(0).cast("long")).alias("first"), F.array(F.lit(int(NEVER) >> 8)).alias("last")
    spans = spans.union(later_copies(keyed).select("key", "print", *whole))
    of_doc = spans.groupBy("key", "print").agg(F.flatten(F.collect_list("first")).alias("first"), F.flatten(F.collect_list("last")).alias("last"))

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "data", AT_ONCE):
                out = []
                for text, first, last in zip(unpressed(part), part.column("first"), part.column("last")):
                    if first.is_valid:
                        first, last = (x.values.to_numpy() for x in (first, last))
                        order = np.argsort(first, kind="stable")
                        first, last, _ = joined_spans(first[order], np.minimum(last[order], len(text)), np.arange(len(first)) == 0)
                        edges = [0, *np.stack([first, last], axis=1).reshape(-1).tolist(), len(text)]
                        kept = b"".join(text[lo:hi] for lo, hi in zip(edges[::2], edges[1::2]))
                        out.append((len(text), len(text) - len(kept), len(first), hashlib.sha256(kept).hexdigest(), kept))
                    else:
                        out.append((len(text), 0, 0, hashlib.sha256(text).hexdigest(), text))
                kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
                columns = [pa.array([x[i] for x in out], kinds[i]) for i in range(4 + with_text)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 1 + len(columns)])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    joined = pressed(keyed, "doc_id", "key", "print").join(of_doc, ["key", "print"], "left")
    return joined.select("doc_id", "data", "first", "last").mapInArrow(rows, schema)
