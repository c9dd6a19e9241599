"""Alignment of two tokenizers, against a direct form over whole texts."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from speedloom.llm import alignment
from speedloom.llm.tokens import VOCABULARY
from tests.llm.conftest import ODD

MORE = ["a▁b", "▁", " lead", "trail ", "two  spaces   here", "<s> </s> <0x41> <unk>", "<|endoftext|><|endoftext|> x", "é́ ﬁ Ａ　", "\x00a\tb \r\n c", "a\U0001f600b", "x y"]


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(VOCABULARY)
    a.encode_special_tokens = True
    table = alignment.byte_characters()
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return (lambda x: a.encode(" " + x, add_special_tokens=False).ids, lambda i: bytes(table[c] for c in a.id_to_token(i))), (b.encode, of_b)


def direct(texts, encoders):
    grouped, count = [], Counter()
    for text in texts:
        tokens = [encode(text) if text else [] for encode, _ in encoders]
        if not text or any(b"".join(map(of, ids)) != (" " + text).encode() for (_, of), ids in zip(encoders, tokens)):
            grouped.append(([], 0, 0))
            continue
        ends = []
        for (_, of), ids in zip(encoders, tokens):
            at, own = 0, []
            for i in ids:
                at += len(of(i))
                own.append(at)
            ends.append(own)
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], [0, 0]
        for end in shared:
            group = []
            for k in (0, 1):
                lo = at[k]
                while at[k] < len(ends[k]) and ends[k][at[k]] <= end:
                    at[k] += 1
                group.append(tokens[k][lo : at[k]])
            groups.append(group)
        grouped.append((groups, len(tokens[0]), len(tokens[1])))
        count.update({(a, b) for x, y in groups for a in x for b in y})
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for groups, n_a, n_b in grouped:
        links = [(a, b) for x, y in groups for a in x for b in y]
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(told.encode()).hexdigest() if groups else ""))
    return out


def check(docs, texts, encoders):
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs).collect()}
    assert got == dict(enumerate(direct(texts, encoders)))


def test_odd_texts_and_an_empty_table(frame, empty, encoders):
    check(frame(ODD + MORE), ODD + MORE, encoders)
    assert alignment.align(empty).collect() == []
    assert [tuple(r) for r in alignment.align(frame([None, ""])).collect()] == [(i, 0, 0, 0, 0, 0, 0, "") for i in (0, 1)]


def test_given_documents(spark, documents, encoders, monkeypatch):
    monkeypatch.setattr(alignment, "SHARD", 5_000)  # many shards
    rows = sorted(documents.select("doc_id", "text").collect())
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(documents).collect()}
    assert got == dict(zip([r.doc_id for r in rows], direct([r.text for r in rows], encoders)))


def test_words_alone_give_the_ids_of_whole_texts(documents):
    pieces = alignment.Pieces(alignment.PIECES)
    assert pieces.by_word
    texts = [x for x in ODD + MORE if x] + [r.text for r in documents.limit(50).collect()]
    for x, ids in zip(texts, pieces(texts)):
        assert ids.tolist() == pieces.model.encode(x), x[:60]


def test_large_groups_are_counted_before_they_are_joined(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(alignment, "LARGE", 20)
    rng = np.random.default_rng(2)
    sizes = [rng.integers(1, 12, 40) for _ in range(2)]
    ids = [pa.array(rng.integers(0, 4, s.sum()), pa.uint32()) for s in sizes]
    group = [np.repeat(np.arange(40), s) for s in sizes]
    want = Counter((g, int(a) << 32 | int(b)) for g in range(40) for a in ids[0].to_numpy()[group[0] == g] for b in ids[1].to_numpy()[group[1] == g])
    got = Counter()
    for r in alignment.links(group, ids, sizes).to_pylist():
        got[r["group"], r["pair"]] += r["w"]
    assert got == want
