"""MinHash near-duplicates (9): b-bit signatures, band candidates, exact confirmation, connected documents.

A document's set holds the hashes of its distinct n-word shingles. It gets MINIMA minima of keyed hashes; BANDS bands of
ROWS minima name its buckets, and the low BITS bits of every minimum, packed as bit planes, are its signature. Documents
with the same set form a class and only its smallest doc_id goes on. Two classes in one bucket are candidates if the
similarity estimated from equal signature entries, corrected for chance collisions of the kept bits, is near the
threshold or above; candidates are confirmed on the full sets, recomputed from the texts.

No bucket is expanded into all its pairs: first every member is compared with the smallest of its bucket and only its best
estimates are confirmed. That joins most members of a group of copies. Then members of one bucket that are still in
different components are compared by signature, in blocks of BLOCK x BLOCK members whatever the size of the bucket. The
members that have a candidate there get their texts, and the block confirms its candidates itself, the best first, as long as
they would join two components; only confirmed links that do, fewer than the block has members, leave the task. A link
between two documents can only be missed if they share no band (6e-7 at a similarity of 0.8, for independent minima) or their
estimate is MARGIN too low (6e-5 there), and either matters only if nothing else connects the two. Minima come from
multiply-add keys, which are independent in pairs only.

Null, empty and blank texts have no shingles and are linked with nothing: their component is their own. Repeated doc_ids
give a row each, with the smallest as component. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from speedloom.llm.common import HASHES, M1, long_lists, mixed, raw, shingle_hashes, slices, stage, whole_groups

ROWS, BANDS, MINIMA, BITS = 3, 20, 256, 4
MARGIN = 0.1
#: Members of a bucket that are compared with each other at a time, and texts that one text is confirmed against.
BLOCK = 1024
#: Of these, as many are compared with all others before what was found is confirmed.
STRIP = 128
KEYS = (mixed(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64) * M1) >> np.uint64(32)).astype(np.uint32)
MULTIPLY, ADD = (KEYS[:MINIMA] | np.uint32(1))[:, None], KEYS[MINIMA:][:, None]


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-word shingles of a text."""
    return np.unique(shingle_hashes(HASHES.of(text.lower().split()), n))


def minima(shingles: np.ndarray) -> np.ndarray:
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), 512):
        keyed = MULTIPLY * short[at : at + 512]
        keyed += ADD
        np.minimum(low, keyed.min(axis=1), out=low)
    return low


def signature(low: np.ndarray) -> np.ndarray:
    """Bit planes of the low bits of the minima: MINIMA / 64 longs for each of BITS planes."""
    planes = (low >> np.arange(BITS, dtype=np.uint32)[:, None]) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8), axis=1).reshape(-1).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low[: BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS)
    h = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for i in range(ROWS):
        h = mixed(h ^ rows[:, i]) * M1
    return h


def features(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature and band keys (null without shingles)."""

    def rows(batches):
        import hashlib

        for batch in batches:
            for part in slices(batch):
                sizes, digests, signs, bands = [], [], [], []
                for text in raw(part):
                    shingles = shingle_set(text, n)
                    sizes.append(len(shingles))
                    if len(shingles):
                        low = minima(shingles)
                        digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                        signs.append(signature(low))
                        bands.append(band_keys(low))
                    else:
                        digests.append(None)
                        signs.append(np.empty(0, np.int64))
                        bands.append(np.empty(0, np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), long_lists(signs), long_lists(bands)],
                    names=["doc_id", "n_shingles", "digest", "sign", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n_shingles long, digest binary, sign array<long>, bands array<long>")


CHANCE = 2.0**-BITS


def estimate(equal):
    """Similarity from the number of equal entries, without those expected to be equal by chance."""
    return (equal / MINIMA - CHANCE) / (1 - CHANCE)


def equal_entries(a: str, b: str) -> F.Column:
    words = MINIMA // 64
    total = F.lit(0)
    for w in range(words):
        differ = F.lit(0).cast("long")
        for plane in range(BITS):
            differ = differ.bitwiseOR(F.col(a)[plane * words + w].bitwiseXOR(F.col(b)[plane * words + w]))
        total = total + 64 - F.bit_count(differ)
    return total


def components(links: DataFrame, name: str) -> DataFrame:
    """id, component of all ends of links (a, b): the smallest id they are connected with.

    Alternates large and small stars: every node hands the smallest of its neighbours to the larger and then to the smaller ones.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges, last = stage(edges, name), None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(low.select("u", F.col("m").alias("v"))).distinct(), name)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == last:
            break
        last = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share at least so many percent of their union."""
    small, large = sorted((a, b), key=len)
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirm(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of documents whose sets share at least so many percent of their union.

    Pairs of one a are confirmed BLOCK at a time, so that a text with very many partners is spread over tasks.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    texts = docs.select(F.col("doc_id").alias("id"), "text").dropDuplicates(["id"])
    own = many.join(texts, many.a == texts.id).select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "text")
    other = pairs.select("a", "b").join(many, "a").join(texts, F.col("b") == texts.id)
    other = other.select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b", "text")

    def rows(batches):
        left = None
        for batch in batches:
            for part in slices(batch):
                out = []
                for a, b, text in zip(part.column("a").to_pylist(), part.column("b").to_pylist(), raw(part)):
                    shingles = shingle_set(text, n)
                    if b is None:
                        left = shingles
                    else:
                        if similar(left, shingles, percent):
                            out.append((a, b))
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    dealt = own.union(other).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return dealt.select("a", "b", "text").mapInArrow(rows, "a long, b long")


def with_estimate(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b, estimate of the pairs that may reach the threshold by their sizes and signatures."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sign").alias(f"sign_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return both.select("a", "b", estimate(equal_entries("sign_a", "sign_b")).alias("estimate")).where(F.col("estimate") >= percent / 100 - MARGIN)


BLOCK_KEYS = ["key", "i", "j"]


def candidate_strips(part: dict[str, np.ndarray], percent: int):
    """Rows of one block pair that lie in different components and may reach the threshold, in pairs with their estimate.

    STRIP rows of a block at a time, by the components as they are then: the caller may join some in between. A pair
    is told only by the first of the bands that it shares: its bucket there also holds two components, so no pair is
    lost and none is told twice.
    """
    everyone = np.arange(len(part["id"]))
    diagonal = part["i"][0] == part["j"][0]
    left, right = (everyone, everyone) if diagonal else (everyone[part["side"] == 0], everyone[part["side"] == 1])
    words, least, earlier = MINIMA // 64, percent / 100 - MARGIN, slice(0, int(part["band"][0]))
    sign, component, n, bands = (part[x] for x in ("sign", "component", "n", "bands"))
    for at in range(0, len(left), STRIP):
        some = left[at : at + STRIP]
        apart = component[some, None] != component[right]
        if not apart.any():
            continue
        equal = np.zeros(apart.shape, np.int64)
        for w in range(words):
            differ = np.zeros(apart.shape, np.int64)
            for plane in range(BITS):
                differ |= sign[some, None, plane * words + w] ^ sign[None, right, plane * words + w]
            equal += 64 - np.bitwise_count(differ.view(np.uint64)).astype(np.int64)  # of signed values it would count the absolute value's bits
        guess = estimate(equal)
        small, large = np.minimum(n[some, None], n[right]), np.maximum(n[some, None], n[right])
        r, c = np.nonzero(apart & (guess >= least) & (100 * small >= percent * large))
        p, q = some[r], right[c]
        new = p < q if diagonal else np.ones(len(p), bool)
        for band in range(earlier.stop):
            new &= bands[p, band] != bands[q, band]
        yield p[new], q[new], guess[r[new], c[new]]


def block_parts(batches):
    """Each block pair of more than one row: its table and its columns as arrays."""
    for whole, starts in whole_groups(batches, BLOCK_KEYS):
        part = {x: whole.column(x).to_numpy() for x in ("i", "j", "side", "band", "id", "component", "n")}
        for x in ("sign", "bands"):
            part[x] = whole.column(x).combine_chunks().flatten().to_numpy().reshape(len(part["id"]), -1)
        for lo, hi in zip(starts, starts[1:]):
            if hi - lo > 1:
                yield whole.slice(lo, hi - lo), {x: v[lo:hi].copy() if x == "component" else v[lo:hi] for x, v in part.items()}


def with_candidates(members: DataFrame, percent: int) -> DataFrame:
    """The members, per pair of blocks of their bucket, that have a candidate in another component there.

    members: band, key, id, component, n, sign, bands, size (of the bucket). They are dealt into blocks, and each pair of
    blocks is compared on its own, so that no bucket has to fit in one task.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    mine = mine.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mine = mine.select("key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), F.when(F.col("block") <= F.col("with"), 0).otherwise(1).alias("side"), "band", "id", "component", "n", "sign", "bands")

    def rows(batches):
        for whole, part in block_parts(batches):
            asked = np.zeros(len(part["id"]), bool)
            for p, q, _ in candidate_strips(part, percent):
                asked[p] = asked[q] = True
            if asked.any():
                yield from whole.filter(pa.array(asked)).to_batches()

    dealt = mine.repartition(*BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS)
    return dealt.mapInArrow(rows, mine.schema)


def links_in_blocks(members: DataFrame, n: int, percent: int) -> DataFrame:
    """a, b: confirmed links that join the components of each block pair (``with_candidates`` and text)."""

    def rows(batches):
        for whole, part in block_parts(batches):
            top: dict[int, int] = {}
            sets: dict[int, np.ndarray] = {}
            texts = whole.column("text")

            def root(c: int) -> int:
                while (up := top.get(c, c)) != c:
                    top[c] = c = top.get(up, up)
                return c

            def shingles(k: int) -> np.ndarray:
                if k not in sets:
                    sets[k] = shingle_set((texts[k].as_py() or "").encode(), n)
                return sets[k]

            ids, out, component = part["id"], [], part["component"]
            for p, q, guess in candidate_strips(part, percent):
                order = np.argsort(-guess, kind="stable")
                for x, y in zip(p[order].tolist(), q[order].tolist()):
                    a, b = root(int(component[x])), root(int(component[y]))
                    if a != b and similar(shingles(x), shingles(y), percent):
                        top[max(a, b)] = min(a, b)
                        out.append((int(ids[x]), int(ids[y])))
                component[:] = [root(c) for c in component.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([min(x) for x in out], pa.int64()), pa.array([max(x) for x in out], pa.int64())], names=["a", "b"])

    dealt = members.repartition(*BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS)
    return dealt.mapInArrow(rows, "a long, b long")


def best(pairs: DataFrame) -> DataFrame:
    """Of each b, the pair with the highest estimate."""
    return pairs.groupBy("b").agg(F.max(F.struct("estimate", "a")).alias("t")).select(F.col("t.a").alias("a"), "b", F.col("t.estimate").alias("estimate"))


def near_duplicates(docs: DataFrame, n: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    seen = stage(features(docs, n), "near-features")
    classes = seen.where("digest is not null").groupBy("digest").agg(F.min_by(F.struct(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sign", "bands"), "doc_id").alias("c"))
    classes = stage(classes.select("digest", "c.*"), "near-classes")
    sketch = classes.select("id", "n", "sign")
    in_band = classes.select("id", F.posexplode("bands").alias("band", "key"))
    shared = in_band.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("size")).where("size > 1")
    members = stage(in_band.join(shared, "key"), "near-members")

    stars = members.where("id != least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    near = best(with_estimate(stars, sketch, percent))
    links = stage(confirm(near, docs, n, percent), "near-links")
    known = components(links, "near-components")

    labelled = members.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = labelled.groupBy("key").agg((F.min("component") != F.max("component")).alias("apart")).where("apart").select("key")
    unsure = labelled.join(split, "key").join(classes.drop("digest"), "id")
    asked = stage(with_candidates(unsure, percent), "near-candidates")
    if not asked.isEmpty():
        texts = docs.select(F.col("doc_id").alias("id"), "text").dropDuplicates(["id"])
        new = stage(links_in_blocks(asked.join(texts, "id"), n, percent), "near-links")
        known = components(links.union(new), "near-components")

    of_class = classes.select("digest", "id").join(known, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    out = seen.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
