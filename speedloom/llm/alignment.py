"""Cross-tokenizer alignment (12): an Arrow pipeline over the tokens of two tokenizers.

A text, with a space before it, is encoded by a byte-level vocabulary (A) and by a sentencepiece model (B, which adds the
space itself). Token lists are flattened with their parents; the sizes of the tokens in bytes, summed within each document,
give (document, end) keys, and an Acero join of both sides' keys gives the ends that they share. These cut the tokens into groups.
Links are the A-B pairs inside a group, joined on the group's number; tokens that repeat in a large group are counted first,
so that such a group costs its distinct tokens. ``Table.group_by`` counts links per document and documents per id pair.

A worker writes a shard for about SHARD distinct (document, pair) entries: the documents' figures, their entries as places in the
shard's list of distinct pairs, and how many of its documents hold each pair. Spark adds the shards' counts; each shard gets the counts of its own pairs back and
sums them per document. So a pair that every document holds is one row per shard.

Texts that are null, empty or not given back by the tokens of both sides have no tokens: zeros and ''. Every row is a document,
also with a repeated or null doc_id. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from speedloom.llm.common import slices, stage, strings
from speedloom.llm.tokens import VOCABULARY, Encoder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Distinct (document, pair) entries of a shard; a document is never split.
SHARD = 500_000
#: Bytes of text that are aligned at a time (one document at least).
AT_ONCE = 1 << 20
#: Words that a worker remembers for each tokenizer, in each of two generations.
WORDS = 100_000
#: Groups with more links than this have their repeated tokens counted before they are joined.
LARGE = 4096
SPACED = re.compile(r"(?<=[^ ]) ")


class Pieces:
    """Ids of texts by a sentencepiece model whose pieces never go on after a space: words are encoded alone and remembered."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.by_word = not any(re.search("[^▁]▁", x) for x in self.names)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.space = np.array([self.names.index("▁")], np.uint32).tobytes()

    def bytes_of(self) -> list[bytes]:
        return [bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(self.names)]

    def learn(self, new: list[str]) -> None:
        fresh = [x for x in new if x not in self.older]
        self.known.update((x, self.older[x]) for x in new if x in self.older)
        ids = self.model.encode(fresh, num_threads=1)
        ends = np.cumsum([0, *map(len, ids)]) * 4
        data = np.fromiter((i for x in ids for i in x), np.uint32, int(ends[-1]) // 4).tobytes()
        self.known.update((x, data[lo:hi]) for x, lo, hi in zip(fresh, ends[:-1].tolist(), ends[1:].tolist()))

    def ids_of(self, words: list[str]) -> list[bytes]:
        if len(self.known) > WORDS:
            self.older, self.known = self.known, {}
        self.known[""] = self.space  # what stands after a space at the end of a text
        out = list(map(self.known.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        self.learn([words[i] for i in missing])
        for i in missing:
            out[i] = self.known[words[i]] if len(words[i]) < 64 else self.known.pop(words[i])  # long ones are not remembered
        return out

    def fill(self, out: list[np.ndarray], rows: list[int], cut: pa.ListArray) -> None:
        ends = cut.offsets.to_numpy()
        words = cut.flatten().dictionary_encode()
        ids = pa.array(self.ids_of(words.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(words.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[ends - ends[0]] // 4
        flat = np.frombuffer(ids.buffers()[2], np.uint32, int(at[-1]))
        for i, lo, hi in zip(rows, at[:-1].tolist(), at[1:].tolist()):
            out[i] = flat[lo:hi]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out = [np.empty(0, np.uint32)] * len(texts)
        plain, other = [], []
        for i, x in enumerate(texts):
            if x:
                (plain if self.by_word and "  " not in x and x[0] != " " and x[-1] != " " else other).append(i)
        if plain:
            self.fill(out, plain, pc.split_pattern(pa.array([texts[i] for i in plain], pa.string()), " "))
        if other:
            self.fill(out, other, pa.array([SPACED.split(texts[i]) if self.by_word else [texts[i]] for i in other], pa.list_(pa.string())))
        return out


def byte_level(token: str, table: dict[str, int]) -> bytes:
    return bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()


def byte_characters() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Side:
    """One tokenizer: how it encodes, and the bytes, sizes and decimal names of its ids."""

    def __init__(self, encode, tokens: list[bytes]):
        self.encode = encode
        self.tokens = pa.array(tokens, pa.large_binary())
        self.sizes = pc.binary_length(self.tokens)
        self.names = pa.array([str(i) for i in range(len(tokens))], pa.large_string())

    def given_back(self, ids: list[np.ndarray], texts: list[bytes]) -> np.ndarray:
        """Whose tokens join to the text."""
        flat = self.tokens.take(pa.array(np.concatenate([np.empty(0, np.uint32), *ids])))
        joined = flat.buffers()[2].to_pybytes() if len(flat) else b""
        ends = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1)[np.cumsum([0, *map(len, ids)])].tolist() if len(flat) else [0] * (len(ids) + 1)
        return np.array([joined[lo:hi] == x for lo, hi, x in zip(ends, ends[1:], texts)], bool)

    def keyed(self, ids: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
        """The flat ids, and the document and end of each as one key."""
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.uint32), *ids])))
        flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
        sums = pc.cumulative_sum(self.sizes.take(flat))
        starts = np.concatenate([[0], sums.to_numpy()])[lists.offsets.to_numpy()[:-1]]
        ends = pc.subtract(sums, pa.array(starts, pa.int64()).take(parents))
        return flat, pc.add(pc.multiply(parents.cast(pa.int64()), 1 << 32), ends).to_numpy()


SIDES: dict[tuple[str, str], tuple[Side, Side]] = {}


def sides(vocabulary: str, pieces: str) -> tuple[Side, Side]:
    """The worker's two tokenizers."""
    if (vocabulary, pieces) not in SIDES:
        a, b, table = Encoder(vocabulary, plain=True, prefix=" ", memory=WORDS), Pieces(pieces), byte_characters()
        names = [a.tokenizer.id_to_token(i) or "" for i in range(a.tokenizer.get_vocab_size())]
        SIDES[vocabulary, pieces] = Side(a, [byte_level(x, table) for x in names]), Side(b, b.bytes_of())
    return SIDES[vocabulary, pieces]


def grouped(names: pa.Array, sizes: np.ndarray, by: str) -> pa.Array:
    """Runs of so many names joined by a mark."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), names), pa.scalar(by, pa.large_string()))


def links(group: list[np.ndarray], ids: list[pa.Array], sizes: list[np.ndarray]) -> pa.Table:
    """group, pair, w: the id pairs inside each group, as a << 32 | b, and how often each occurs."""
    alone = (sizes[0] == 1) & (sizes[1] == 1)
    each = [x.to_numpy().astype(np.int64) for x in ids]
    one = [alone[g] for g in group]
    simple = pa.table({"group": group[0][one[0]], "pair": each[0][one[0]] << 32 | each[1][one[1]], "w": np.ones(int(one[0].sum()), np.int64)})
    large = sizes[0] * sizes[1] > LARGE
    both = []
    for g, x, single, name in zip(group, each, one, "ab"):
        rows = pa.table({"group": g[~single], name: x[~single], f"w{name}": np.ones(int((~single).sum()), np.int64)})
        many = large[g[~single]]
        if many.any():
            counted = rows.filter(pa.array(many)).group_by(["group", name], use_threads=False).aggregate([(f"w{name}", "sum")])
            counted = counted.rename_columns({f"w{name}_sum": f"w{name}"}).select(["group", name, f"w{name}"])
            rows = pa.concat_tables([rows.filter(pa.array(~many)), counted])
        both.append(rows)
    found = both[0].join(both[1], keys="group", join_type="inner", use_threads=False)
    pair = pc.add(pc.multiply(found.column("a"), 1 << 32), found.column("b"))
    found = pa.table({"group": found.column("group"), "pair": pair, "w": pc.multiply(found.column("wa"), found.column("wb"))})
    return pa.concat_tables([simple, found])


def aligned(texts: list[str], two: tuple[Side, Side]) -> tuple[dict[str, np.ndarray], list[str], pa.Table]:
    """Figures of each text, digests of their groups, and the entries doc, pair, w of all."""
    raw = [b" " + x.encode() if x else b"" for x in texts]
    ids = [side.encode(texts) for side in two]
    good = np.logical_and.reduce([side.given_back(x, raw) for side, x in zip(two, ids)])
    ids = [[x if ok else x[:0] for x, ok in zip(one, good)] for one in ids]
    (a, a_keys), (b, b_keys) = (side.keyed(x) for side, x in zip(two, ids))
    shared = pa.table({"key": a_keys}).join(pa.table({"key": b_keys}), keys="key", join_type="left semi", use_threads=False)
    ends = np.sort(shared.column("key").to_numpy())
    group = [np.searchsorted(ends, k) for k in (a_keys, b_keys)]
    sizes = [np.bincount(g, minlength=len(ends)) for g in group]
    doc = ends >> 32
    n = len(texts)
    figures = {"n_a": np.array(list(map(len, ids[0])), np.int64), "n_b": np.array(list(map(len, ids[1])), np.int64)}
    figures["n_groups"] = np.bincount(doc, minlength=n)
    all_links = np.concatenate([[0], np.cumsum(sizes[0] * sizes[1])])
    last = np.cumsum(figures["n_groups"])
    figures["n_links"] = all_links[last] - all_links[last - figures["n_groups"]]
    told = pc.binary_join_element_wise(*(grouped(side.names.take(x), size, ",") for side, x, size in zip(two, (a, b), sizes)), pa.scalar("|", pa.large_string()))
    told = grouped(told, figures["n_groups"], ";")
    digests = [hashlib.sha256(x).hexdigest() if x else "" for x in told.cast(pa.large_binary()).to_pylist()]
    found = links(group, [a, b], sizes)
    found = found.set_column(0, "doc", pa.array(doc).take(found.column("group")))
    entries = found.group_by(["doc", "pair"], use_threads=False).aggregate([("w", "sum")])
    return figures, digests, entries.rename_columns({"w_sum": "w"})


FIGURES = ("n_a", "n_b", "n_groups", "n_links")
SHARD_SCHEMA = "shard string, doc_id array<long>, " + ", ".join(f"{x} array<long>" for x in FIGURES) + ", digests array<string>, n_entries array<long>, places binary, weights binary, pairs array<long>, docs array<long>"


def shards(docs: DataFrame, vocabulary: str, pieces: str) -> DataFrame:
    """One row per shard of documents; staged, since each shard has a name of its own."""

    def closed(held: list) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=1).compress
        sizes = [len(x[0]) for x in held]
        entries = pa.concat_tables([x[3].set_column(x[3].schema.get_field_index("doc"), "doc", pc.add(x[3].column("doc"), at)) for x, at in zip(held, np.cumsum([0, *sizes]).tolist())])
        doc = entries.column("doc").to_numpy()
        order = np.argsort(doc, kind="stable")
        counts = entries.group_by("pair", use_threads=False).aggregate([("doc", "count")]).sort_by("pair")
        pairs = counts.column("pair").to_numpy()
        places = np.searchsorted(pairs, entries.column("pair").to_numpy()[order]).astype(np.uint32)
        weights = entries.column("w").to_numpy()[order].astype(np.uint64)
        values = [uuid.uuid4().hex, [i for x in held for i in x[0]]]
        values += [np.concatenate([x[1][name] for x in held]) for name in FIGURES]
        values += [[d for x in held for d in x[2]], np.bincount(doc, minlength=sum(sizes)), press(places.tobytes()), press(weights.tobytes()), pairs, counts.column("doc_count").to_numpy()]
        kinds = [pa.string(), *[pa.list_(pa.int64())] * (1 + len(FIGURES)), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.binary(), *[pa.list_(pa.int64())] * 2]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[x.split()[0] for x in SHARD_SCHEMA.split(", ")])

    def rows(batches):
        two, held, entries = sides(vocabulary, pieces), [], 0
        for batch in batches:
            for part in slices(batch, size=AT_ONCE):
                held.append((part.column("doc_id").to_pylist(), *aligned(strings(part), two)))
                entries += held[-1][3].num_rows
                if entries >= SHARD:
                    yield closed(held)
                    held, entries = [], 0
                    pa.default_memory_pool().release_unused()
        if held:
            yield closed(held)

    return stage(docs.select("doc_id", "text").mapInArrow(rows, SHARD_SCHEMA), "alignment-shards")


def align(docs: DataFrame, vocabulary: str = VOCABULARY, pieces: str = PIECES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    parts = shards(docs, vocabulary, pieces)
    counts = parts.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n"))
    counts = stage(counts, "alignment-counts")
    of_a = F.shiftright("pair", 32)
    most = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))  # one row per id of A's vocabulary
    known = counts.join(F.broadcast(most), of_a == most.a).select("pair", "n", (F.col("n") == F.col("most")).alias("top"))
    asked = parts.select("shard", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(known, "pair").groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("place", "n", "top"))).alias("known"))
    answers = answers.select("shard", F.col("known.n").alias("n"), F.col("known.top").alias("top"))

    def rows(batches):
        press = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name).slice(k, 1) for name in batch.schema.names}
                flat = lambda name: row[name].flatten()
                places = np.frombuffer(press(row["places"][0].as_py()), np.uint32)
                weights = np.frombuffer(press(row["weights"][0].as_py()), np.int64)
                ends = np.concatenate([[0], np.cumsum(flat("n_entries").to_numpy())])
                out = []
                for value in ("top", "n"):
                    known = flat(value).to_numpy(zero_copy_only=False).astype(np.int64)
                    total = np.concatenate([[0], np.cumsum((known[places] if len(places) else places) * weights)])
                    out.append(pa.array((total[ends[1:]] - total[ends[:-1]]).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([flat("doc_id"), *map(flat, FIGURES), *out, flat("digests")], names=["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"])

    joined = parts.drop("pairs", "docs").join(answers, "shard", "left").drop("shard")  # a shard of empty texts has no pairs
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    joined = joined.withColumn("n", F.coalesce("n", empty("long"))).withColumn("top", F.coalesce("top", empty("boolean")))
    schema = "doc_id long, " + ", ".join(f"{x} long" for x in FIGURES) + ", n_best long, count_sum long, groups_sha256 string"
    return joined.mapInArrow(rows, schema)
