"""Token counts (7): unigram segmentation of distinct pre-tokens over a shared trie.

A text is cut into pre-tokens at white space; each is preceded by the mark of a word's beginning. Pieces and their scores come
from a public sentencepiece vocabulary: a piece's log-probability follows its rank (log of 1 / rank, normalised), as the file's own
scores are ranks. The forward score of a prefix is the best sum of log-probabilities of pieces that spell it; equal scores take
fewer tokens. Distinct pre-tokens are inserted in a trie, the score of each prefix is computed once, where its node is made, and a
pre-token's token count is kept at its terminal. A character without a piece costs its UTF-8 bytes, a token each, below the
rarest piece.

Null, empty and blank texts have no pre-tokens and no tokens. Repeated rows are counted alike. An empty table gives an empty result.
Only doc_id and text are read.
"""

from __future__ import annotations

import math

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from speedloom.llm.common import slices, strings

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
#: Nodes that a worker's trie may have before it starts anew.
NODES = 600_000


class Trie:
    """Best segmentation of every prefix seen: score and tokens at each node, counts of whole pre-tokens beside."""

    def __init__(self, pieces: dict[str, float], unknown: float):
        self.pieces, self.unknown = pieces, unknown
        self.longest = max(map(len, pieces), default=1)
        self.reset()

    def reset(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.best: list[tuple[float, int]] = [(0.0, 0)]  # score, minus tokens
        self.terminal: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """Tokens of a pre-token."""
        if len(self.next) > NODES:
            self.reset()
        path, pieces, best = [0], self.pieces, self.best
        for end, char in enumerate(word, 1):
            node = self.next[path[-1]].get(char)
            if node is None:
                node = self.next[path[-1]][char] = len(self.next)
                self.next.append({})
                size = len(char.encode())
                score, tokens = best[path[-1]]
                top = (score + self.unknown * size, tokens - size)
                for begin in range(max(0, end - self.longest), end):
                    piece = pieces.get(word[begin:end])
                    if piece is not None:
                        score, tokens = best[path[begin]]
                        top = max(top, (score + piece, tokens - 1))
                best.append(top)
            path.append(node)
        count = self.terminal[word] = -best[path[-1]][1]
        return count


def unigram_pieces(vocabulary: str = VOCABULARY) -> tuple[dict[str, float], float]:
    """Log-probability of each ordinary piece, and that of a byte of an unknown character."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ranked = sorted(usual, key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / r for r in range(1, len(ranked) + 1)))
    return {model.id_to_piece(i): -math.log(r) - total for r, i in enumerate(ranked, 1)}, -math.log(len(ranked) + 1) - total - 10.0


TRIES: dict[str, Trie] = {}


def trie(vocabulary: str) -> Trie:
    """The worker's trie of a vocabulary file."""
    if vocabulary not in TRIES:
        TRIES[vocabulary] = Trie(*unigram_pieces(vocabulary))
    return TRIES[vocabulary]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every document."""

    def rows(batches):
        tree = trie(vocabulary)
        for batch in batches:
            for part in slices(batch):
                words = [x.split() for x in strings(part)]
                known = {w: tree.terminal.get(MARK + w) for w in set().union(*words)}
                for w in sorted(w for w, n in known.items() if n is None):
                    known[w] = tree.insert(MARK + w)
                n = [sum(map(known.__getitem__, x)) for x in words]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(map(len, words), pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n_pretokens long, n_tokens long")
