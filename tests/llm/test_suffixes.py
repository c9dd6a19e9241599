"""Repeated passages by merged Burrows-Wheeler transforms, against a dictionary of all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from speedloom.llm import suffixes
from tests.llm.conftest import ODD


def direct(rows):
    """doc_id -> figures; rows: (doc_id, text). Null ids are greater than all others."""
    key = lambda i: suffixes.NEVER if i is None else i
    least = {}
    data = [(i, (x or "").encode()) for i, x in rows]
    for i, x in data:
        for at in range(len(x) - 49):
            w = x[at : at + 50]
            least[w] = min(least.get(w, key(i)), key(i))
    out = []
    for i, x in data:
        gone = bytearray(len(x))
        for at in range(len(x) - 49):
            if least[x[at : at + 50]] < key(i):
                gone[at : at + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(docs, rows):
    got = suffixes.repeated_passages(docs)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == direct(rows)


def passages(n=60):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    told = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared = [told(30) for _ in range(6)] + ["x" * 49, "x" * 50, "ab" * 60, told(7)]
    return [(i, " ".join(rng.choice([told(rng.randint(0, 12)), rng.choice(shared)]) for _ in range(rng.randint(0, 5)))) for i in range(n)]


def test_passages_in_many_surroundings(spark, monkeypatch):
    rows = passages()
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 3000)  # many buckets, shards and frequent anchors
    monkeypatch.setattr(suffixes, "STRINGS", 40)
    monkeypatch.setattr(suffixes, "ANCHORS", 100)
    monkeypatch.setattr(suffixes, "HOT", 5)
    monkeypatch.setattr(suffixes, "CHUNK", 256)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), rows)


def test_odd_texts_and_ids(spark, odd, empty):
    check(odd.select("doc_id", "text", "spans"), [tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert suffixes.repeated_passages(empty).collect() == []
    p, q = "passage " * 9, "the other passage, which is longer than fifty bytes, I should think"
    rows = [(None, p), (7, "a " + p), (7, p + q), (3, q), (None, q + " end"), (9, None), (9, q), (8, q.replace("other", "othér"))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_given_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    check(documents.withColumn("anchors", F.lit(1)).withColumn("key", F.lit("k")), rows)


def test_kept_bytes(documents):
    for r in suffixes.repeated_passages(documents, with_text=True).limit(50).collect():
        assert len(r.kept) == r.n_bytes - r.n_removed and hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


@pytest.mark.parametrize("seed", range(4))
def test_merged_transforms(seed):
    """Transforms hold the symbols before the sorted suffixes, and merged ones tell the smallest owner of each window."""
    rng = random.Random(seed)
    made = lambda: bytes(rng.choice([0, 1, 255]) for _ in range(rng.randint(50, 82)))
    shared = [made() for _ in range(10)]
    shards = [sorted({rng.choice(shared) if rng.random() < 0.4 else made() for _ in range(rng.randint(1, 30))}) for _ in range(4)]
    transforms = [suffixes.transform(x) for x in shards]
    for strings, got in zip(shards, transforms):
        rows = sorted((s[k:], i, s[k - 1] + 1 if k else 0) for i, s in enumerate(strings) for k in range(len(s) + 1))
        assert got.tolist() == [r[2] for r in rows]
    owners = [np.array([rng.randint(0, 99) for _ in x]) for x in shards]
    counts = [np.array([len(s) - 49 for s in x]) for x in shards]
    least = {}
    for strings, own in zip(shards, owners):
        for s, i in zip(strings, own.tolist()):
            for k in range(len(s) - 49):
                least[s[k : k + 50]] = min(least.get(s[k : k + 50], i), i)
    for strings, got in zip(shards, suffixes.window_minima(transforms, owners, counts)):
        assert got.tolist() == [least[s[k : k + 50]] for s in strings for k in range(len(s) - 49)]


@pytest.mark.parametrize("texts", [1, 40, 1 << 17])
def test_pairs_by_value(texts):
    """With few texts a pair is one word; with many it is sorted by both."""
    rng = np.random.default_rng(texts)
    names = rng.integers(0, 1 << 48, texts)
    keys = np.concatenate([names, names[rng.integers(0, texts, 3000)]])
    values = rng.integers(0, 1 << 48, len(keys)).astype(np.uint64)
    values[::3] = values[0]
    got = suffixes.distinct_pairs(values, keys)
    assert list(zip(*(x.tolist() for x in got))) == sorted(set(zip(values.tolist(), keys.tolist())))


def test_names_inside_old_classes():
    rng = np.random.default_rng(4)
    old = np.sort(rng.integers(0, 30, 500))
    old = np.searchsorted(old, old)  # named by their first place
    key = np.sort(old * 8 + rng.integers(0, 8, 500))
    name, company = suffixes.named(key, key >> 3)
    assert name.tolist() == [int((key >> 3)[i] + np.searchsorted(key, key[i]) - np.searchsorted(key >> 3, (key >> 3)[i])) for i in range(500)]
    assert company.tolist() == [(key == k).sum() > 1 for k in key]
    assert suffixes.named(key)[0].tolist() == np.searchsorted(key, key).tolist()


def test_known_values():
    x = np.array([5, 1, 9, 1], np.uint64)
    assert suffixes.stands_in(x, np.array([9, 5, 5], np.uint64)).tolist() == [True, False, True, False]
    assert not suffixes.stands_in(x, np.empty(0, np.uint64)).any()


def test_few_rows_for_many_buckets(spark, monkeypatch):
    """A shard sends a row for each part, not for each bucket, so that rows do not grow with the square of the input."""
    rows, staged = passages(200), {}

    def keep(df, name, stage=suffixes.stage):
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(suffixes, "stage", keep)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 200)
    check(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), rows)
    buckets = -(-sum(len(x) for _, x in rows) // 200)
    parts = -(-buckets // suffixes.TOGETHER)
    told = staged["passage-shards"].where("transform is not null").groupBy("shard").count().collect()
    assert told and buckets > 100 and max(r["count"] for r in told) <= parts


def test_transforms_of_groups():
    rng = random.Random(9)
    groups = [sorted({bytes(rng.choice([0, 1, 255]) for _ in range(rng.randint(50, 82))) for _ in range(rng.randint(1, 20))}) for _ in range(7)]
    number = np.repeat(np.arange(7) * 3 + 2, [len(x) for x in groups])
    want = np.concatenate([suffixes.transform(x) for x in groups])
    assert suffixes.transform([x for group in groups for x in group], number).tolist() == want.tolist()


def test_minima_of_a_part():
    """Each bucket has its own classes; a shard may hold nothing of a bucket."""
    rng = random.Random(5)
    shared = [bytes(rng.choice([0, 1]) for _ in range(rng.randint(50, 60))) for _ in range(6)]
    held = [[sorted(rng.sample(shared, rng.randint(0, 4))) for _ in range(5)] for _ in range(3)]
    owners = [[np.array([rng.randint(0, 99) for _ in x], np.int64) for x in shard] for shard in held]
    counts = [[np.array([len(y) - 49 for y in x], np.int64) for x in shard] for shard in held]
    none = np.empty(0, np.uint16)
    transforms = [[none, *(suffixes.transform(x) for x in shard if x)] for shard in held]
    joined = [np.concatenate([x for shard in told for x in shard]) for told in (transforms, owners, counts)]
    got = suffixes.part_minima(np.array([[len(x) for x in shard] for shard in held]), *joined)
    want = [[] for _ in held]
    for b in range(5):
        least = {}
        for own, x in ((o, y) for i in range(3) for o, y in zip(owners[i][b].tolist(), held[i][b])):
            for k in range(len(x) - 49):
                least[x[k : k + 50]] = min(least.get(x[k : k + 50], own), own)
        for i in range(3):
            want[i] += [least[x[k : k + 50]] for x in held[i][b] for k in range(len(x) - 49)]
    assert [x.tolist() for x in got] == want
