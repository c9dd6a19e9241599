"""Quality classifier (10): compressed sizes under a dictionary of good and one of bad text.

Two zstandard dictionaries are trained, one on good and one on bad labelled documents. A document is compressed
in chunks of CHUNK bytes, each with both dictionaries, so that its end counts as much as its start. Its feature is the difference of
its two compressed sizes, summed over all chunks, over its size; a rising curve, fitted on other labelled documents by isotonic regression with the
classes at their true shares, turns it into a score: the estimated share of good documents.
Only rows whose crc32(doc_id) mod 3 is not 1 take part in the fit: remainder 0 trains the dictionaries, 2 the curve.

Fitting uses a bounded sample of texts of every length: of each class and remainder the SAMPLE rows with the smallest hash of doc_id.
The dictionaries are trained on at most SAMPLE_CHARS characters of each, from a place given by the hash; the curve's features,
like those of scoring, are those of whole texts. Null text counts as empty; an empty
text has feature 0. A doc_id with several labels counts as good only if all are good. Without labels of both classes
all scores are 0.5. An empty table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from speedloom.llm.common import raw, slices

#: Labelled texts of each class for the dictionaries, and as many for the curve.
SAMPLE = 1500
SAMPLE_CHARS = 20_000
#: Bytes that are compressed at a time: few enough for the dictionaries to tell more than the chunk's own history.
CHUNK = 8192
DICTIONARY_BYTES = 112_640
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    #: the curve: features and the score at each, straight lines between them
    x: tuple[float, ...]
    y: tuple[float, ...]


def remainder(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def by_hash() -> tuple:
    return F.xxhash64("doc_id"), "doc_id"


def labelled(docs: DataFrame, labels: DataFrame, part: int, sample: int) -> dict[int, DataFrame]:
    """doc_id, text: all rows of at most ``sample`` doc_ids of each class, the same ones in every run."""
    marks = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    full = docs.where((remainder(F.col("doc_id")) == part) & (F.length("text") > 0)).select("doc_id", "text")
    rows = full.select("doc_id").distinct().join(marks, "doc_id")
    out = {}
    for quality in (0, 1):
        # the ids are chosen first, so that only the texts of the sample move; the broadcast side has ``sample`` rows at most
        ids = rows.where(F.col("quality") == quality).orderBy(*by_hash()).limit(sample).select("doc_id")
        out[quality] = full.join(F.broadcast(ids), "doc_id")
    return out


def pieces(rows: DataFrame, sample: int) -> list[bytes]:
    """At most ``sample`` texts; of a long one SAMPLE_CHARS characters, from a place that the hash of doc_id gives."""
    begin = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1)).cast("int")
    rows = rows.select("doc_id", F.col("text").substr(begin + 1, F.lit(SAMPLE_CHARS)).alias("text"))
    return [r.text.encode() for r in rows.orderBy(*by_hash(), "text").limit(sample).select("text").collect()]


def sampled_features(rows: DataFrame, model: Model, sample: int) -> np.ndarray:
    """Features of at most ``sample`` whole texts; the texts stay with the workers."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def values(batches):
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(features(sent.value, raw(part)))], names=["doc_id", "x"])

    found = rows.select("doc_id", "text").mapInArrow(values, "doc_id long, x double")
    return np.array([r.x for r in found.orderBy(*by_hash(), "x").limit(sample).collect()])


def trained(texts: list[bytes], size: int) -> bytes:
    """A dictionary of the texts; the texts themselves if they are too few to train on."""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, texts)) // 4)), texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-size:]


def sizer(dictionary: bytes):
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    press = zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)
    return lambda text: sum(len(press.compress(text[i : i + CHUNK])) for i in range(0, len(text), CHUNK))


def features(model: Model, texts: list[bytes]) -> np.ndarray:
    good, bad = sizer(model.good), sizer(model.bad)
    return np.array([(bad(x) - good(x)) / len(x) if x else 0.0 for x in texts])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """The rising step function closest to y, as the mean x and the level of each step."""
    order = np.lexsort((y, x))
    steps: list[list[float]] = []  # weight, sum of x, sum of y
    for i in order:
        steps.append([weight[i], weight[i] * x[i], weight[i] * y[i]])
        while len(steps) > 1 and (steps[-2][1] / steps[-2][0] >= steps[-1][1] / steps[-1][0] or steps[-2][2] * steps[-1][0] >= steps[-1][2] * steps[-2][0]):
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last)]
    return tuple(b / a for a, b, _ in steps), tuple(c / a for a, _, c in steps)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """None where a class has no text."""
    texts = {quality: pieces(rows, sample) for quality, rows in labelled(docs, labels, 0, sample).items()}
    if not all(texts.values()):
        return None
    model = Model(trained(texts[1], DICTIONARY_BYTES), trained(texts[0], DICTIONARY_BYTES), (), ())
    held = {quality: sampled_features(rows, model, sample) for quality, rows in labelled(docs, labels, 2, sample).items()}
    if not all(map(len, held.values())):
        return None
    marks = labels.where("quality is not null").where(remainder(F.col("doc_id")) == 2)
    share = {r.quality: r["count"] for r in marks.groupBy("quality").count().collect()}
    x = np.concatenate([held[0], held[1]])
    n = [len(held[0]), len(held[1])]
    curve = isotonic(x, np.repeat([0.0, 1.0], n), np.repeat([share[0] / n[0], share[1] / n[1]], n))
    return Model(model.good, model.bad, *curve)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        fitted = sent.value
        for batch in batches:
            for part in slices(batch):
                x = features(fitted, raw(part)) if fitted else np.zeros(part.num_rows)
                p = np.interp(x, fitted.x, fitted.y) if fitted else x + 0.5
                ids = part.column("doc_id")
                out = [None if i is None else zlib.crc32(str(i).encode()) % 3 == 1 for i in ids.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(out, pa.bool_()), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"]
                )

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, held_out boolean, score double, predicted int")


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
