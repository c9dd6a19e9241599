"""Quality rules (1): log-likelihood ratio of hashed n-grams between trusted and raw text.

Words and word pairs are hashed into a fixed number of buckets. One multinomial over the buckets is counted from all
trusted documents, one from all documents. In each bucket the trusted count and the count expected at the raw share are both
raised by PRIOR, so that few observations say little. A document's score is the mean over its words and pairs of
log(trusted / raw). Every document whose score is below the threshold, or that fails a base rule, is not kept.

Null text counts as empty: no words, base rules fail, score 0. Repeated rows are counted and judged like any other.
An empty table gives an empty result; without trusted documents all scores are 0.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from speedloom.llm.common import HASHES, raw, shingle_hashes, slices

#: log2 of the buckets of the multinomials: the model has this many numbers, whatever the input.
BUCKET_BITS = 17
#: Least mean log ratio of a kept document.
THRESHOLD = -0.15
PRIOR = 5.0
SYMBOLS = b"#*$%&|<>"
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean"


def buckets(words: list[bytes], bits: int) -> np.ndarray:
    """Bucket of every word and of every pair of words that follow each other."""
    h = HASHES.of(words)
    grams = [shingle_hashes(h, 1)] + [shingle_hashes(h, 2)] * (len(h) > 1)
    return (np.concatenate(grams) >> np.uint64(64 - bits)).astype(np.int64)


def bucket_counts(docs: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """bucket, n over all texts; each task sums its own before the shuffle."""

    def count(batches):
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for part in slices(batch):
                for text in raw(part):
                    if words := text.split():
                        np.add.at(total, buckets(words, bits), 1)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["bucket", "n"])

    return docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def log_ratios(docs: DataFrame, trusted: DataFrame, bits: int = BUCKET_BITS) -> np.ndarray:
    """log(trusted / raw) of each bucket; the driver gets one row per bucket at most."""

    def counts(df: DataFrame) -> np.ndarray:
        rows = df.toArrow()
        n = np.zeros(1 << bits)
        n[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
        return n

    good, everything = counts(bucket_counts(trusted, bits)), counts(bucket_counts(docs, bits))
    expected = everything * (good.sum() / max(1.0, everything.sum()))
    return np.log((good + PRIOR) / (expected + PRIOR))


def line_repeats(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if not x.isspace() and x]
    return len(lines) - len(set(lines))


def window_repeats(words: list[bytes], n: int = 3) -> int:
    """Words inside n-word windows that occur twice or more in the text."""
    if len(words) < n:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    last = len(words) - n + 1
    window = code[:last]
    for i in range(1, n):
        _, window = np.unique(window * len(ids) + code[i : i + last], return_inverse=True)
    again = np.bincount(window)[window] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:last] += again
    edges[n : n + last] -= again
    return int((np.cumsum(edges) > 0).sum())


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """Base counts, score and verdict of every document."""
    bits = len(ratios).bit_length() - 1
    sent = docs.sparkSession.sparkContext.broadcast(ratios.astype(np.float64))

    def rows(batches):
        ratio = sent.value
        for batch in batches:
            for part in slices(batch):
                out = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), raw(part)):
                    words = text.split()
                    n = len(words)
                    repeats = window_repeats(words)
                    chars = len(b"".join(words).decode())
                    symbols = len(text) - len(text.translate(None, SYMBOLS))
                    failed = n < 50 or 100 * repeats > 50 * n
                    score = float(ratio[buckets(words, bits)].mean()) if n else 0.0
                    out.append((doc_id, n, chars, symbols, line_repeats(text), repeats, failed, score, not failed and score >= threshold))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(rows, SCHEMA)


def trusted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with a label of good quality, once each."""
    good = labels.where("quality = 1").select("doc_id").distinct()
    return docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left_semi")  # no bound is known for a broadcast


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return judge(docs, log_ratios(docs, trusted_documents(docs, labels)), threshold)
