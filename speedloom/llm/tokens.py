"""Token ids of whole texts by the tokenizers library.

A byte-level pre-tokenizer always cuts before a single space or line feed that stands between two characters which
are not white space, so the ids of a text are those of the pieces between such places. Each worker remembers the
ids of the pieces it has met and encodes only new ones, many in one call. The string of a special token in a text gets that
token's id, as the library does by default.
"""

from __future__ import annotations

import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Pieces in each of the two generations that a worker remembers; about 200 bytes each.
PIECE_MEMORY = 400_000
#: Pieces that are encoded in one call.
AT_ONCE = 20_000
PLACES = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: White space in pairs, and any but space and line feed: texts with these are cut by PLACES.
RARE_SPACE = [a + b for a in " \n" for b in " \n"] + [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
#: A word of plain letters with marks after it: byte-level pre-tokenizers cut between the two.
MARKED = re.compile(r"(\n?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]+)")


class Encoder:
    """Ids of texts as unsigned 32-bit integers.

    With ``plain``, strings of special tokens in a text are ordinary text; ``prefix`` stands before every text that is not empty.
    """

    def __init__(self, vocabulary: str, plain: bool = False, prefix: str = "", memory: int = PIECE_MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.prefix, self.memory = Tokenizer.from_file(vocabulary), prefix, memory
        self.tokenizer.encode_special_tokens = plain
        sizes = {i: len(self.tokenizer.id_to_token(i)) for i in self.tokenizer.get_vocab().values()}
        self.sizes = np.zeros(max(sizes) + 1, np.int64)  # a token has one character for each of its bytes
        self.sizes[list(sizes)] = list(sizes.values())
        self.known: dict[str, bytes] = {}  # by piece, without its leading space
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}  # of what stands without a space before it
        self.first: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)  # without offsets

    def alone(self, text: str, memory: dict[str, bytes]) -> bytes:
        if text not in memory:
            if len(memory) >= self.memory // 10:
                memory.clear()
            memory[text] = self.encode(text).tobytes()
        return memory[text]

    def learn(self, new: set[str]) -> None:
        """Know the pieces, which have no leading space."""
        old = new & self.older.keys()
        self.known.update((x, self.older[x]) for x in old)
        ends_open = {x for x in new - old if x[-1].isspace()}  # the end of a text: nothing may follow it
        self.known.update((x, self.encode(x if x[0] == "\n" else " " + x).tobytes()) for x in ends_open)
        todo = list(new - old - ends_open)
        for lo in range(0, len(todo), AT_ONCE):
            some = todo[lo : lo + AT_ONCE]
            whole = [x if x[0] == "\n" else " " + x for x in some]
            ids = self.encode("".join(whole))
            ends = np.cumsum([len(x.encode()) for x in whole])
            token_ends = np.cumsum(self.sizes[ids])
            cuts = np.searchsorted(token_ends, ends) + 1
            if not np.array_equal(token_ends[cuts - 1], ends):  # cannot happen with a byte-level vocabulary
                raise ValueError("pieces and tokens end at different places")
            data, at = ids.tobytes(), 0
            for piece, end in zip(some, (cuts * 4).tolist()):
                self.known[piece] = data[at:end]
                at = end

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces; a word with marks after it is put together from the word and the marks."""
        if len(self.known) > self.memory:
            self.older, self.known = self.known, {}
        out = list(map(self.known.get, pieces))
        missing = [i for i, x in enumerate(out) if x is None]
        parted = {i: m.groups() for i in missing if not pieces[i][-1].isalnum() and (m := MARKED.fullmatch(pieces[i]))}
        words = {i: parted[i][0] if i in parted else pieces[i] for i in missing}
        self.learn(set(words.values()).difference(self.known))
        for i, word in words.items():
            out[i] = self.known[word] + self.alone(parted[i][1], self.marks) if i in parted else self.known[word]
        return out

    def joined(self, pieces: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of documents that are cut into pieces, and where each document's begin and end."""
        ends = pieces.offsets.to_numpy().astype(np.int64)
        flat = pieces.flatten()
        ends = ends - ends[0]
        table = flat.dictionary_encode()
        heads = [self.alone(self.prefix + x, self.first) for x in flat.take(pa.array(ends[:-1])).to_pylist()]
        of = table.indices.to_numpy().copy()
        ids = pa.array(self.ids_of(table.dictionary.to_numpy(zero_copy_only=False).tolist()) + heads, pa.large_binary())
        of[ends[:-1]] = len(table.dictionary) + np.arange(len(heads))
        whole = ids.take(pa.array(of))
        at = np.frombuffer(whole.buffers()[1], np.int64, len(whole) + 1) // 4
        data = whole.buffers()[2]
        return np.frombuffer(data, np.uint32, int(at[-1])) if data is not None else np.empty(0, np.uint32), at[ends]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out = [np.empty(0, np.uint32)] * len(texts)
        plain, other = [], []
        for i, x in enumerate(texts):
            if x:
                rare = x[0].isspace() or x[-1].isspace() or any(map(x.__contains__, RARE_SPACE))
                (other if rare else plain).append(i)
        if plain:
            lines = pc.replace_substring(pa.array([texts[i] for i in plain], pa.string()), "\n", " \n")
            self.fill(out, plain, pc.split_pattern(lines, " "))
        if other:
            cut = [PLACES.split(texts[i]) for i in other]
            cut = [[x[1:] if k and x[0] == " " else x for k, x in enumerate(row)] for row in cut]
            self.fill(out, other, pa.array(cut, pa.list_(pa.string())))
        return out

    def fill(self, out: list[np.ndarray], rows: list[int], pieces: pa.ListArray) -> None:
        ids, ends = self.joined(pieces)
        for i, lo, hi in zip(rows, ends[:-1].tolist(), ends[1:].tolist()):
            out[i] = ids[lo:hi]


ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if vocabulary not in ENCODERS:
        ENCODERS[vocabulary] = Encoder(vocabulary)
    return ENCODERS[vocabulary]
