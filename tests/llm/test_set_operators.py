"""Packing, token files, sharding, near-duplicates, classifier and the pipeline."""

from __future__ import annotations

import random
import uuid
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from speedloom.llm import classifier, huffman, neardup, packing, sharding
from speedloom.llm.common import shared_folder
from speedloom.llm.tokens import VOCABULARY, Encoder
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def direct():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(direct):
    encoder = Encoder(VOCABULARY)
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "The", "é", "ß,", "1", " ", "  ", "\n", "\n\n", "\t", "'s", ".", "...", "&&", "\x85", "　", "日", "\x1c"]) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for x, ids in zip(texts, encoder(texts)):
        assert ids.tolist() == direct(x), repr(x)


def test_tournament_tree_is_first_fit():
    rng = random.Random(2)
    for _ in range(50):
        sizes = sorted((rng.randint(1, 40) for _ in range(rng.randint(1, 60))), reverse=True)
        room = []
        want = []
        for x in sizes:
            at = next((i for i, r in enumerate(room) if r >= x), len(room))
            if at == len(room):
                room.append(40)
            want.append((at, 40 - room[at]))
            room[at] -= x
        assert packing.first_fit(sizes, 40) == want


def check_packing(docs, texts, direct):
    rows = packing.pack(docs).collect()
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append(r)
        assert len(r.ids) == 4 * r.length
    for i, text in texts.items():
        ids = [*direct(text), 1]
        parts = sorted(of_doc[i], key=lambda r: r.start)
        assert np.frombuffer(b"".join(bytes(r.ids) for r in parts), "<u4").tolist() == ids
        assert [r.start for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))] and all(r.doc_tokens == len(ids) for r in parts)
    for parts in of_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return sum(r.length for r in rows), 2048 * len(of_sequence)


def test_packing(documents, odd, empty, direct):
    used, room = check_packing(documents, {r.doc_id: r.text for r in documents.collect()}, direct)
    assert used > 0.93 * room
    check_packing(odd, dict(enumerate(ODD)), direct)
    assert packing.pack(empty).count() == 0


def test_code_lengths():
    rng = np.random.default_rng(4)
    for limit in (4, 6, 18):
        counts = rng.integers(0, 1000, 14) ** 3
        bits = huffman.code_lengths(counts, limit)
        used = bits[bits > 0]
        assert used.max() <= limit and (2.0 ** -used).sum() <= 1 and ((bits > 0) == (counts > 0)).all()
    # without a binding limit the size is that of a plain Huffman code
    import heapq

    heap, total = sorted(counts[counts > 0].tolist()), 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    assert (bits * counts).sum() == total


def test_blocks_decode_alone():
    rng = np.random.default_rng(5)
    for n in (1, 63, 64, 65, 5000):
        ids = (rng.zipf(1.3, n) % 900).astype(np.uint32)
        lengths = huffman.code_lengths(np.bincount(ids, minlength=900))
        bits, checkpoints = huffman.pack_bits(ids, huffman.canonical_codes(lengths), lengths)
        assert np.array_equal(huffman.Decoder(lengths)(bits, checkpoints, n), ids)


def check_files(spark, docs, texts, direct, block):
    path = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    huffman.write_token_files(docs, path, block=block)
    rows = {r.doc_id: r for r in huffman.read_token_files(spark, path).collect()}
    assert rows.keys() == texts.keys()
    start = 0
    for i in sorted(texts):
        ids = np.array([*direct(texts[i]), 0], "<u4")
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        assert bytes(rows[i].ids) == ids.tobytes()
        start += len(ids)


def test_token_files(spark, documents, odd, empty, direct):
    shuffled = documents.orderBy(F.xxhash64("doc_id"))
    check_files(spark, shuffled, {r.doc_id: r.text for r in documents.collect()}, direct, 5000)
    check_files(spark, odd, dict(enumerate(ODD)), direct, huffman.BLOCK)
    check_files(spark, empty, {}, direct, huffman.BLOCK)
    twice = huffman.token_files(odd.union(odd)).collect()
    assert sorted(r.start for r in twice)[1:] == sorted(r.start + r.n_tokens for r in twice)[:-1]


def check_shards(docs, texts, shards):
    rows = sharding.shard(docs, shards).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    of_text, slots, sizes = {}, defaultdict(list), defaultdict(int)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data)) and 0 <= r.shard < shards
        assert of_text.setdefault(data, r.shard) == r.shard
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    return [sizes[i] for i in range(shards)]


def test_sharding(spark, documents, odd, empty, monkeypatch):
    texts = {r.doc_id: r.text for r in documents.collect()}
    sizes = check_shards(documents, texts, 5)
    assert max(sizes) - min(sizes) < 0.01 * max(sizes)
    check_shards(odd, dict(enumerate(ODD)), 40)
    assert sharding.shard(empty).count() == 0
    monkeypatch.setattr(sharding, "BLOCK", 9)
    groups = spark.range(300).select(F.col("id").alias("key"), (F.col("id") * F.col("id") % 1009 + 1).alias("bytes"))
    got = sharding.group_shards(groups, 4, block=9).join(groups, "key").groupBy("shard").agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == 300 and max(r.b for r in got) - min(r.b for r in got) <= 60


def slow_groups(texts, n, percent):
    sets = {}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()
    group = {i: i for i in texts}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                group[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("block", [1024, 2])
def test_near_duplicates(documents, frame, odd, empty, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    family = [" ".join(rng.choice("xyz") + str(rng.random()) if rng.random() < rate else w for w in base) for rate in (0.01, 0.02, 0.03, 0.05) for _ in range(12)]
    for docs, n in ((frame(family + ODD), 4), *(((documents, 4), (documents, 5)) if block > 2 else ())):
        texts = {r.doc_id: r.text for r in docs.collect()}
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, n).collect()}
        assert got == slow_groups(texts, n, 80)
    assert neardup.near_duplicates(empty).count() == 0
    if block > 2:
        again = neardup.near_duplicates(odd.union(odd)).collect()
        assert len(again) == 2 * len(ODD) and {r.component_id for r in again if r.doc_id in (0, 1, 2)} == {0, 1, 2}


def test_classifier(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    model = classifier.fit(docs, labels)
    held = classifier.remainder(F.col("doc_id")) == 1
    # labels of held-out rows change nothing
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    assert classifier.fit(docs, turned) == model
    rows = classifier.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    for quality, least in ((1, 0.9), (0, 0.7)):
        mine = [r.predicted == quality for r in rows if r.quality == quality]
        assert sum(mine) >= least * len(mine)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    got = classifier.score(odd, model).collect()
    assert [r.held_out for r in sorted(got)] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(len(ODD))]
    assert {r.score for r in classifier.quality_classifier(docs, labels.where("quality = 1")).collect()} == {0.5}
    assert classifier.score(empty, model).count() == 0


def test_classifier_of_long_texts(spark, frame):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    held = docs.join(labels, "doc_id").where((classifier.remainder(F.col("doc_id")) == 1) & F.col("quality").isNotNull())
    texts = {0: [], 1: []}
    for r in held.orderBy("doc_id").collect():
        texts[r.quality].append(r.text)
    bad, good = (" ".join(texts[quality] * (2_000_000 // len(" ".join(texts[quality])) + 1)) for quality in (0, 1))
    sizes = (400_000, 1_000_000, 2_000_000)
    long = [bad[:n] for n in sizes] + [good[:n] for n in sizes] + [good[:60_000] + bad[:1_900_000]]
    model = classifier.fit(docs, labels)
    got = {r.doc_id: r.predicted for r in classifier.score(frame(long), model).collect()}
    assert [got[i] for i in range(7)] == [0, 0, 0, 1, 1, 1, 0]
    # every length takes part in the fit
    only = docs.where(F.length("text") <= 5000).withColumn("text", F.repeat("text", 20)).where(F.length("text") > classifier.SAMPLE_CHARS)
    assert classifier.fit(only, labels) is not None


def test_isotonic_rises():
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=300), rng.integers(0, 2, 300).astype(float)
    a, b = classifier.isotonic(x, y, np.ones(300))
    assert list(a) == sorted(a) and list(b) == sorted(b) and 0 <= b[0] and b[-1] <= 1


def test_pipeline(spark, sf_dir, documents, direct):
    docs, seen = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == documents.columns
        docs = spark.createDataFrame(after.toArrow(), after.schema)
        seen.append({r.doc_id: r.text for r in docs.collect()})
    first = {r.doc_id for r in classifier.quality_classifier(documents, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1").collect()}
    assert seen[0].keys() == first
    groups = slow_groups(seen[0], 5, 80)
    assert seen[1].keys() == {i for i, (_, g) in groups.items() if i == g}
    assert seen[2].keys() <= seen[1].keys() and seen[3].keys() == seen[2].keys()
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    ends = defaultdict(int)
    for r in rows:
        ends[r.doc_id] += r.length
    assert dict(ends) == {i: len(direct(t)) + 1 for i, t in seen[3].items()}
