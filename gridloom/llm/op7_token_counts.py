"""Token counts under a unigram model, by dynamic programming shared over a trie of pre-tokens.

A pre-token is a word with the piece mark U+2581 before it. Each distinct pre-token is inserted in
a trie; a node holds the best score of any segmentation of its prefix and the token count of that
segmentation, worked out once when the node is made, from the nodes above it. The node where a
pre-token ends gives its count, so shared prefixes are scored once. Scores are integers, so that
sums are exact; of equal scores the fewer tokens win. A character in no piece falls back to one
token a UTF-8 byte.

The trie lives in the worker and is begun anew once it has ``max_nodes`` nodes, and so are the kept
counts (both are caches; counts do not depend on them). Words beyond ``MAX_KEPT_CHARS`` characters leave
the trie there: the rest is scored in a window as long as the longest piece, so that a word of any length
takes as much memory as its own text. Words are found, hashed and told apart in whole columns; each
distinct one of a slice is looked up once. Nothing is shuffled.

The public file carries ranks, not frequencies: a piece of rank r is scored as Zipf's law would have it.

Defined cases: null or blank text: 0 pre-tokens and 0 tokens; an empty table gives no rows; a row for
each row of repeated ids; null ids stay null; of equal scores the fewer tokens win; very long words and
texts are scored whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import common
from gridloom.llm.shingles import cased_words, column_bytes

MARK = "▁"
#: Integer score units of one nat, and the score of a byte of an unknown character.
UNIT, BYTE_NATS = 1_000_000, 12
#: Bounds of a worker's caches: trie nodes, characters of a word in the trie, kept counts.
MAX_NODES, MAX_KEPT_CHARS, MAX_COUNTS = 400_000, 64, 600_000


def zipf_scores(pieces: list[str]) -> dict[str, int]:
    """Log-probability of the piece of rank r as -ln(r + 2): the public files carry ranks, not frequencies."""
    return {piece: -round(UNIT * math.log(rank + 2)) for rank, piece in reversed(list(enumerate(pieces)))}


def public_pieces(model_path: str) -> list[str]:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class TrieCounter:
    def __init__(self, scores: dict[str, int], max_nodes: int = MAX_NODES):
        self._scores, self._max = scores, max_nodes
        self._longest = max(map(len, scores), default=1)
        #: The longest piece that ends with one or two characters: fewer starts to try.
        self._ending: dict[str, int] = {}
        for piece in scores:
            self._ending[piece[-2:]] = max(len(piece), self._ending.get(piece[-2:], 1))
        self._known: dict[int, int] = {}
        self._clear()

    def _clear(self) -> None:
        self._child: dict[int, int] = {}
        self._best: list[tuple[int, int]] = [(0, 0)]

    def _scored(self, text: str, end: int, before: list[tuple[int, int]]) -> tuple[int, int]:
        """Best (score, -tokens) of the prefix of length ``end``; ``before`` has those of the shorter ones, the nearest last."""
        char = text[end - 1]
        width = 1 if char < "\x80" else len(char.encode("utf-8", "surrogatepass"))
        score, tokens = before[-1]
        score, tokens = score - width * BYTE_NATS * UNIT, tokens - width
        piece = self._scores.get(char)
        if piece is not None and (one := (before[-1][0] + piece, before[-1][1] - 1)) > (score, tokens):
            score, tokens = one
        for back in range(2, min(self._ending.get(text[end - 2 : end], 1), end, len(before)) + 1):
            piece = self._scores.get(text[end - back : end])
            if piece is not None and (one := (before[-back][0] + piece, before[-back][1] - 1)) > (score, tokens):
                score, tokens = one
        return score, tokens

    def count(self, word: str) -> int:
        """Tokens of the pre-token of ``word``: along the trie, which grows where needed, then in a window."""
        if len(self._best) > self._max:
            self._clear()
        text, node, child, best = MARK + word, 0, self._child, self._best
        before = [best[0]]
        for char in text[:MAX_KEPT_CHARS]:
            following = child.get((node << 21) | ord(char))
            if following is None:
                break
            node = following
            before.append(best[node])
        for end in range(len(before), min(len(text), MAX_KEPT_CHARS) + 1):
            before.append(self._scored(text, end, before))
            child[(node << 21) | ord(text[end - 1])] = node = len(best)
            best.append(before[-1])
        for end in range(MAX_KEPT_CHARS + 1, len(text) + 1):
            before.append(self._scored(text, end, before))
            if len(before) > 4 * self._longest:
                del before[: -self._longest]
        return -before[-1][1]

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens and tokens of each text of a column."""
        raw, bounds = column_bytes(column)
        hashes, starts, ends = cased_words(raw, bounds)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self._known) > MAX_COUNTS:
            self._known = {}
        found = list(map(self._known.get, distinct.tolist()))
        for i, n in enumerate(found):
            if n is None:
                word = raw[starts[first[i]] : ends[first[i]]].tobytes().decode("utf-8", "surrogatepass")
                found[i] = self._known[int(distinct[i])] = self.count(word)
        upto = np.concatenate([[0], np.cumsum(np.array(found, np.int64)[inverse])])
        at = np.searchsorted(starts, bounds)
        return np.diff(at), np.diff(upto[at])


_LOADED: dict[str, TrieCounter] = {}


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_pretokens and n_tokens of every text."""

    def work(part: pa.RecordBatch) -> dict:
        if model_path not in _LOADED:
            _LOADED[model_path] = TrieCounter(zipf_scores(public_pieces(model_path)))
        pretokens, tokens = _LOADED[model_path].counts(part.column(1))
        return {"doc_id": part.column(0), "n_pretokens": pretokens, "n_tokens": tokens}

    return common.map_slices(common.texts_of(docs), work, "doc_id long, n_pretokens long, n_tokens long")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return token_counts(common.documents(spark, sf_dir), public.path("piece_bpe_32k.model"))
