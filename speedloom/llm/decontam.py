"""Benchmark decontamination (6): prefix-filtered join of benchmark windows with documents.

A window is WINDOW consecutive words of an item (all words of a shorter item). Its set are the SHINGLE-word shingles in it (the whole
of a shorter window). All shingles of the benchmark are counted over all documents and ordered by that count, the rarest first. As a
contained window has all its shingles in the document, its first one is a sufficient prefix: only places of a document with
such a shingle are joined. The shingle's place in the window gives the only possible start (positional bound), the window must
lie inside the document (length bound), and it is then compared word by word.

The filters that documents are scanned with have a fixed size (2 MB), whatever the size of the benchmark; beyond them
everything is joined by shuffles. Null and blank texts have no words: documents get zeros, items no windows. Repeated items count as
items of their own, repeated document rows get a row each. Empty tables give empty results or zeros. Only doc_id, item_id and
text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from speedloom.llm.common import HASHES, bit_filter, passes, raw, shingle_hashes, slices, stage

WINDOW, SHINGLE = 13, 5
#: Least percentage of hit words of a contaminated document.
PERCENT = 5
#: Lower-cases A-Z and turns ASCII other than letters and digits into spaces.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item_id, the words of each window joined by spaces, and the hashes of its shingles in order."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                ids, texts, hashes = [], [], []
                for item, text in zip(part.column("item_id").to_pylist(), raw(part)):
                    words = words_of(text)
                    h = HASHES.of(words)
                    size = min(window, len(words))
                    for at in range(len(words) - size + 1 if words else 0):
                        ids.append(item)
                        texts.append(b" ".join(words[at : at + size]).decode())
                        hashes.append(shingle_hashes(h[at : at + size], shingle).view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(hashes, pa.list_(pa.int64()))], names=["item_id", "window", "shingles"])

    return benchmark.select("item_id", "text").mapInArrow(rows, "item_id long, window string, shingles array<long>")


def places(words: list[bytes], sizes: list[int], bits: np.ndarray):
    """Hash and place of the shingles of the given sizes that pass the filter."""
    h = HASHES.of(words)
    found, at = [], []
    for size in sizes:
        if len(h) >= size:
            s = shingle_hashes(h, size)
            hit = np.flatnonzero(passes(bits, s))
            found.append(s[hit])
            at.append(hit)
    return (np.concatenate(found), np.concatenate(at)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))


def shingle_counts(docs: DataFrame, sizes: list[int], keys: bytes) -> DataFrame:
    """shingle, n over all documents of the shingles that pass the filter; summed in each batch before the shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(keys)

    def rows(batches):
        bits = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            for part in slices(batch):
                got = [places(words_of(text), sizes, bits)[0] for text in raw(part)]
                h, n = np.unique(np.concatenate(got) if got else np.empty(0, np.uint64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

    return docs.select("text").mapInArrow(rows, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def marked_places(docs: DataFrame, sizes: list[int], keys: bytes, window: int) -> DataFrame:
    """doc_id, row, n_words and places: shingle, place, place of the first word of its surroundings, and these."""
    sent = docs.sparkSession.sparkContext.broadcast(keys)
    schema = "doc_id long, n_words long, places array<struct<shingle:long,at:long,lo:long,around:string>>"

    def rows(batches):
        bits = np.frombuffer(sent.value, np.uint8)
        kind = pa.list_(pa.struct([("shingle", pa.int64()), ("at", pa.int64()), ("lo", pa.int64()), ("around", pa.string())]))
        for batch in batches:
            for part in slices(batch):
                sizes_, found = [], []
                for text in raw(part):
                    words = words_of(text)
                    h, at = places(words, sizes, bits)
                    sizes_.append(len(words))
                    los = np.maximum(at - window + 1, 0).tolist()
                    found.append([{"shingle": s, "at": p, "lo": lo, "around": b" ".join(words[lo : p + window]).decode()} for s, p, lo in zip(h.view(np.int64).tolist(), at.tolist(), los)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes_, pa.int64()), pa.array(found, kind)], names=["doc_id", "n_words", "places"])

    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document row."""
    of_items = stage(item_windows(benchmark, window, shingle), "bench-windows")
    windows = of_items.groupBy("window").agg(F.first("shingles").alias("shingles"), F.size(F.split("window", " ")).alias("size"))
    keys = windows.select(F.explode("shingles").alias("shingle"))
    sizes = sorted(r.s for r in windows.select(F.least("size", F.lit(shingle)).alias("s")).distinct().collect())  # at most ``shingle`` of them

    counts = shingle_counts(docs, sizes, bit_filter(keys, "shingle"))
    each = windows.select("window", "size", F.posexplode("shingles").alias("offset", "shingle"))
    order = F.struct(F.coalesce("n", F.lit(0)), "shingle", "offset")
    first = each.join(counts, "shingle", "left").groupBy("window", "size").agg(F.min(order).alias("o"))
    prefix = stage(first.select("window", "size", "o.shingle", "o.offset"), "bench-prefix")

    seen = stage(marked_places(docs, sizes, bit_filter(prefix, "shingle"), window).withColumn("row", F.monotonically_increasing_id()), "bench-places")
    near = seen.select("row", "n_words", F.explode("places").alias("p")).select("row", "n_words", "p.*").join(prefix, "shingle")
    near = near.withColumn("start", F.col("at") - F.col("offset")).where("start >= 0 and start + size <= n_words")
    held = F.array_join(F.slice(F.split("around", " "), (F.col("start") - F.col("lo") + 1).cast("int"), F.col("size")), " ")
    hits = stage(near.where(held == F.col("window")).select("row", "start", "size", "window").distinct(), "bench-hits")

    before = F.max(F.col("start") + F.col("size")).over(W.partitionBy("row").orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    spans = hits.groupBy("row", "start").agg(F.max("size").alias("size")).withColumn("from", F.greatest("start", F.coalesce(before, F.lit(0))))
    hit = spans.groupBy("row").agg(F.sum(F.greatest(F.col("start") + F.col("size") - F.col("from"), F.lit(0))).alias("n_hit"))
    items = hits.select("row", "window").join(of_items.select("item_id", "window"), "window").select("row", F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy("row").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"))

    out = seen.select("row", "doc_id", "n_words").join(hit, "row", "left").join(items, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)).alias("contaminated"),
    )
